import __spark_entry__ as E


def test_contract_keys_align():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2 and df.columns[0] == "system"


def test_plain_session_from_another_directory(tmp_path):
    """The driver's way: a plain session, another cwd; Python-worker code must not need the package installed."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4") \\
    .config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
assert len(E.entry(spark).collect()) == 2
for key in ("polygon_overlay", "nearest_uneven", "census_one_line", "feature_collection"):
    assert E.queries()[key](spark, "/root/testdata/sf0.001").count() > 0
print("PLAIN-OK")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "PLAIN-OK" in out.stdout, out.stderr[-3000:]
