"""Mergeable sketches: estimates within the stated errors, rolled up without the lines."""

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import sketches
from cartwheel.plans.common import fact_from_testdata, valid_lines
from tests.conftest import SF001


@pytest.fixture(scope="module")
def lines(spark):
    return valid_lines(fact_from_testdata(spark, SF001), require_customer=True).cache()


def test_a_stored_cube_answers_every_grain(spark, lines, tmp_path):
    path = str(tmp_path / "cube")
    sketches.distinct_cube(lines).write.parquet(path)
    cube = spark.read.parquet(path)
    for keys, key in (({"month": F.date_format("day", "yyyy-MM")}, F.date_format("invoice_date", "yyyy-MM")),
                      ({"country": F.col("country")}, F.col("country")), ({"all": F.lit(1)}, F.lit(1))):
        name = next(iter(keys))
        rough = sketches.roll_up(cube, keys)
        plan = rough._jdf.queryExecution().optimizedPlan().toString()
        assert "invoice_no" not in plan  # the lines are not read again
        got = {r[0]: r for r in rough.select(name, "revenue", "n_lines", *[sketches.estimate(k).alias(k) for k in sketches.COUNTED]).collect()}
        want = lines.groupBy(key.alias(name)).agg(F.sum("total_line_revenue").alias("revenue"), F.count(F.lit(1)).alias("n_lines"),
                                                  *[F.count_distinct(c).alias(k) for k, c in sketches.COUNTED.items()]).collect()
        assert len(got) == len(want)
        for w in want:
            assert got[w[0]].revenue == w.revenue and got[w[0]].n_lines == w.n_lines
            for k in sketches.COUNTED:
                assert abs(got[w[0]][k] - w[k]) <= max(1, sketches.DISTINCT_ERROR * w[k])


def test_new_days_are_appended_to_the_cube(lines):
    early, late = lines.where("invoice_date < '1996-01-01'"), lines.where("invoice_date >= '1996-01-01'")
    keys = {"all": F.lit(1)}
    both = sketches.roll_up(sketches.distinct_cube(early).unionByName(sketches.distinct_cube(late)), keys)
    once = sketches.roll_up(sketches.distinct_cube(lines), keys)
    cols = ["revenue", "n_lines", *[sketches.estimate(k).alias(k) for k in sketches.COUNTED]]
    a, b = both.select(*cols).first(), once.select(*cols).first()
    assert (a.revenue, a.n_lines) == (b.revenue, b.n_lines)
    for k, c in sketches.COUNTED.items():  # estimates depend on the order of merging within the error
        n = lines.select(c).distinct().count()
        assert all(abs(x[k] - n) <= max(1, sketches.DISTINCT_ERROR * n) for x in (a, b))


def test_distinct_error_on_many_values(spark):
    df = spark.range(300_000).select(F.col("id").cast("string").alias("invoice_no"), (F.col("id") % 70_000).alias("customer_id"),
                                     (F.col("id") % 900).cast("string").alias("stock_code"), F.lit("UK").alias("country"),
                                     F.lit("2011-01-01").cast("timestamp_ntz").alias("invoice_date"), F.lit(1).cast("decimal(38,8)").alias("total_line_revenue"))
    r = sketches.distinct_cube(df).select(*[sketches.estimate(k).alias(k) for k in sketches.COUNTED]).first()
    for k, n in (("orders", 300_000), ("customers", 70_000), ("products", 900)):
        assert abs(r[k] - n) <= sketches.DISTINCT_ERROR * n


def test_nulls_are_not_counted_and_no_lines_give_no_rows(spark, lines):
    blank = lines.limit(5).withColumn("customer_id", F.lit(None).cast("long"))
    assert {r[0] for r in sketches.distinct_cube(blank).select(sketches.estimate("customers")).collect()} == {0}
    assert sketches.distinct_cube(lines.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["id", "id % 3", "exp(id / 10000.0)", "case when id % 3 = 0 then 7 else id end"])
def test_quantiles_within_the_rank_error(spark, shape):
    df = spark.range(100_000).select(F.expr(shape).cast("double").alias("v"))
    probs, names = [(1, 5), (1, 2), (97, 100), (1, 1)], ["a", "b", "c", "d"]
    points = sketches.approx_quantiles(df, "v", probs, names)
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "rangepartitioning" not in plan
    for r, (num, den) in zip(sorted(sketches.rank_share(df, "v", points, names).collect()), probs):
        assert r.below - sketches.RANK_ERROR <= num / den <= r.upto + sketches.RANK_ERROR


def test_segments_keep_no_sketch_per_customer(spark):
    """sketch_segments: sketches are made per segment; those of customers filled a task's memory."""
    lines = spark.createDataFrame([(c, f"i{c}-{k}", f"s{k}", k + 1) for c in range(300) for k in range(3)],
                                  "customer_id long, invoice_no string, stock_code string, total_line_revenue long")
    lines = lines.withColumn("invoice_date", F.lit("2010-12-01").cast("timestamp_ntz")).withColumn("country", F.lit("F"))
    rfm = spark.createDataFrame([(c, "Lost" if c % 3 else "Champions") for c in range(300)], "customer_id long, rfm_segment string")
    out = sketches.segment_sketches(lines, rfm)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("[")[1] for line in plan.splitlines() if "Aggregate [" in line]
    assert keys and all(k.startswith("rfm_segment") for k in keys)
    for r in out.collect():
        n = 200 if r.rfm_segment == "Lost" else 100
        assert abs(r.customers - n) <= sketches.DISTINCT_ERROR * n and abs(r.orders - 3 * n) <= sketches.DISTINCT_ERROR * 3 * n
        assert (r.products, r.revenue) == (3, 6.0 * n)
