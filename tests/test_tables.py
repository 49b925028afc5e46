"""Shared tables: one build per name and input, also across applications."""

import os
import subprocess
import sys
import tempfile

from cartwheel.operators.rfm import app_rfm
from cartwheel.plans.common import fact_from_testdata
from cartwheel.plans.registry import QUERIES
from cartwheel.plans.tables import forget, input_signature, materialize, tables_root
from tests.conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_materialize_builds_once_per_input(spark):
    d1, d2 = tempfile.mkdtemp(prefix="in1-"), tempfile.mkdtemp(prefix="in2-")
    for d, n in ((d1, 3), (d2, 5)):
        with open(os.path.join(d, "x.txt"), "w") as fh:
            fh.write("x" * n)
    builds = []

    def build(k):
        def f():
            builds.append(k)
            return spark.range(k)
        return f

    a = materialize(spark, "memo_test", d1, build(3))
    b = materialize(spark, "memo_test", f"file://{d1}", build(99))  # same input: no rebuild
    c = materialize(spark, "memo_test", d2, build(5))    # other input: own table
    assert builds == [3, 5] and a.count() == b.count() == 3 and c.count() == 5
    with open(os.path.join(d1, "y.txt"), "w") as fh:     # changed input: rebuilt, remote spelling too
        fh.write("y")
    assert materialize(spark, "memo_test", f"file://{d1}", build(7)).count() == 7
    assert len(input_signature(spark, d1)) == 3
    root = tables_root(spark)
    forget(spark)
    assert not os.path.exists(root.removeprefix("file:"))
    assert materialize(spark, "memo_test", d2, build(4)).count() == 4 and builds == [3, 5, 7, 4]


def test_second_application_reads_the_table():
    shared, data = tempfile.mkdtemp(prefix="shared-"), tempfile.mkdtemp(prefix="in-")
    code = f"""
from cartwheel.plans.tables import materialize
from cartwheel.session import build_session
s = build_session("local[1]", extra={{"spark.checkpoint.dir": "file://{shared}"}})
def build():
    print("BUILT")
    return s.range(4)
print("ROWS", materialize(s, "t", "{data}", build).count())
"""
    runs = [subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120).stdout for _ in range(2)]
    assert "BUILT" in runs[0] and "BUILT" not in runs[1] and all("ROWS 4" in r for r in runs)


def test_customers_need_no_stored_fact(spark):
    """The dashboard's customers are made in one pass over the cleaned lines: a stored fact table is read, but none is
    written for them."""
    root = tables_root(spark).removeprefix("file:")
    found = []
    for first in (["app_rfm"], ["q01_monthly_revenue", "app_rfm"]):
        forget(spark)
        for name in first:
            rows = QUERIES[name](spark, SF001).collect()
        found.append(({n.rsplit("-", 1)[0] for n in os.listdir(root)}, sorted(rows)))
    assert [names for names, _ in found] == [{"app_rfm"}, {"app_rfm", "fact_transactions"}]
    assert found[0][1] == found[1][1] and found[0][1]


def test_customers_of_no_lines(spark):
    fact = fact_from_testdata(spark, SF001)
    assert app_rfm(fact.where("quantity < 0")).count() == 0
