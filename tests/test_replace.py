"""Replace-writes that are cut short, and the split of kept and rejected rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.clean import clean_transactions, quality_counts, write_split
from cartwheel.sources import conform_raw, read_table, write_table
from cartwheel.sources import replace as rp
from cartwheel.sources.testdata import raw_text
from tests.conftest import SF001


class Killed(Exception):
    pass


def _rows(spark, path):
    return sorted(r[0] for r in read_table(spark, path).select("id").collect())


@pytest.mark.parametrize("step", [0, 1])
def test_a_killed_switch_leaves_a_whole_table(spark, tmp_path, monkeypatch, step):
    target = str(tmp_path / "t")
    write_table(spark.range(3), target)
    moves, move = [], rp.move

    def dies(*a):
        if len(moves) == step:
            raise Killed
        moves.append(a)
        move(*a)

    monkeypatch.setattr(rp, "move", dies)
    with pytest.raises(Killed):
        write_table(spark.range(10, 14), target)
    monkeypatch.setattr(rp, "move", move)
    assert os.path.exists(target) == (step == 0)
    assert _rows(spark, target) == [0, 1, 2]
    write_table(spark.range(20, 22), target)  # the next write clears what the dead one left
    assert _rows(spark, target) == [20, 21] and os.listdir(tmp_path) == ["t"]


def test_a_killed_write_leaves_the_old_table(spark, tmp_path):
    target = str(tmp_path / "t")
    write_table(spark.range(3), target)
    with pytest.raises(Exception, match="stop"):
        write_table(spark.range(9).withColumn("x", F.when(F.col("id") > 7, F.raise_error(F.lit("stop")))), target)
    assert _rows(spark, target) == [0, 1, 2]


def test_after_the_second_move_the_new_table_stays(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    write_table(spark.range(3), target)
    real = rp.remove
    monkeypatch.setattr(rp, "remove", lambda s, p: (_ for _ in ()).throw(Killed()) if rp.OLD in p else real(s, p))
    with pytest.raises(Killed):
        write_table(spark.range(10, 12), target)
    monkeypatch.setattr(rp, "remove", real)
    assert _rows(spark, target) == [10, 11]
    rp.recover(spark, target)
    assert _rows(spark, target) == [10, 11] and os.listdir(tmp_path) == ["t"]


def test_a_table_is_replaced_by_a_query_on_itself(spark, tmp_path):
    target = str(tmp_path / "t")
    write_table(spark.range(6), target)
    write_table(read_table(spark, target).where("id % 2 = 0"), target)
    assert _rows(spark, target) == [0, 2, 4]


def test_only_the_partitions_of_the_new_rows_are_replaced(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    parts = lambda df: df.withColumns({"y": F.col("id") % 2, "m": F.col("id") % 3})
    write_table(parts(spark.range(12)), target, partition_by=["y", "m"])
    new = parts(spark.range(12, 24)).where("y = 0 and m < 2")
    write_table(new, target, partition_by=["y", "m"], only_partitions=True)
    kept = [i for i in range(12) if not (i % 2 == 0 and i % 3 < 2)]
    want = sorted(kept + [i for i in range(12, 24) if i % 2 == 0 and i % 3 < 2])
    assert _rows(spark, target) == want and os.listdir(tmp_path) == ["t"]
    moves, move = [], rp.move

    def dies(*a):
        if len(moves) == 3:  # the second partition is moved aside, but not yet replaced
            raise Killed
        moves.append(a)
        move(*a)

    monkeypatch.setattr(rp, "move", dies)
    with pytest.raises(Killed):
        write_table(parts(spark.range(24, 36)).where("y = 0 and m < 2"), target, partition_by=["y", "m"], only_partitions=True)
    monkeypatch.setattr(rp, "move", move)
    rp.recover(spark, target)
    left = read_table(spark, target)
    assert left.where("y = 1 or m = 2").count() == 8  # untouched
    for m in (0, 1):  # each partition is the old or the new one, whole
        own = sorted(r.id for r in left.where(f"y = 0 and m = {m}").collect())
        assert own in ([i for i in range(12, 24) if i % 6 == [0, 4][m]], [i for i in range(24, 36) if i % 6 == [0, 4][m]])
    with pytest.raises(ValueError):
        write_table(new, target, only_partitions=True)


def test_catalog_tables(spark, monkeypatch):
    name = "replace_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_table(spark.range(3), name)
    write_table(spark.range(5, 7), name)
    assert _rows(spark, name) == [5, 6]
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old_x")  # as a writer that died between its renames leaves it
    assert _rows(spark, name) == [5, 6]
    write_table(spark.range(1), name)
    assert _rows(spark, name) == [0]
    assert [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{name}*'").collect()] == [name]
    spark.sql(f"DROP TABLE {name}")


def test_split_keeps_every_row_once(spark, tmp_path):
    fact, rejected = str(tmp_path / "fact"), str(tmp_path / "rejected")
    text = raw_text(spark, SF001).cache()
    obs = write_split(conform_raw(text, keep_cells=True), fact, rejected)
    kept, out = read_table(spark, fact), read_table(spark, rejected)
    want = clean_transactions(conform_raw(text))
    assert kept.select(want.columns).exceptAll(want).count() == 0 == want.exceptAll(kept.select(want.columns)).count()
    counts = quality_counts(conform_raw(text)).first().asDict()
    assert obs.get == counts and kept.count() == counts["rows_kept"] and kept.count() + out.count() == counts["rows_in"]
    found = {r.reason: r["count"] for r in out.select(F.explode("reject_reasons").alias("reason")).groupBy("reason").count().collect()}
    assert found == {k: counts[k] for k in found} and {"bad_date", "bad_price", "bad_qty", "null_customer", "cancelled"} == set(found)
    cells = json.loads(out.where(F.array_contains("reject_reasons", "bad_date")).first().cells)
    assert cells["InvoiceDate"] == "no date" and set(cells) == set(text.columns)
    assert sorted(os.listdir(tmp_path)) == ["fact", "rejected"]


def test_split_with_one_side_empty(spark, tmp_path):
    text = raw_text(spark, SF001).where("InvoiceDate = 'no date'").limit(3)
    fact, rejected = str(tmp_path / "fact"), str(tmp_path / "rejected")
    write_split(conform_raw(text, keep_cells=True), fact, rejected)
    assert read_table(spark, fact).count() == 0 and read_table(spark, rejected).count() == 3
