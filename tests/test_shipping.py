"""Executors need the public libraries only, and the retail queries none of the corpus part's."""

import os
import subprocess
import sys
import tempfile

from tests.conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code):
    # From another folder; the workers' path does not hold the repository.
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {ROOT!r})\n" + code], cwd=tempfile.mkdtemp(prefix="elsewhere-"),
                          env=env, capture_output=True, text=True, timeout=150)


def test_the_model_runs_where_workers_have_no_repository():
    r = _run(f"""
import __spark_entry__ as E
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
     .config("spark.checkpoint.dir", "file://" + {tempfile.mkdtemp(prefix='shared-')!r}).getOrCreate())
def there(_):
    import importlib.util
    return importlib.util.find_spec("cartwheel") is not None
assert s.sparkContext.parallelize([1], 1).map(there).collect() == [False]
for name in ("clv_predict_fixed", "clv_loglik_fixed", "clv_fit_predict"):
    print(name, E.queries()[name](s, {SF001!r}).count())
""")
    assert r.returncode == 0, r.stderr[-2000:]
    assert [x.split()[0] for x in r.stdout.splitlines() if x.startswith("clv_")] == ["clv_predict_fixed", "clv_loglik_fixed", "clv_fit_predict"]


def test_without_a_library_of_the_corpus_part_the_others_are_listed():
    r = _run("""
sys.modules["ahocorasick"] = None
import __spark_entry__ as E
names = set(E.queries())
assert "q01_monthly_revenue" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(E.oracle_sql()) <= names
""")
    assert r.returncode == 0, r.stderr[-2000:]
