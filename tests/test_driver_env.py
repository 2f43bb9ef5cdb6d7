"""The registered queries must run in a plain session started from any working
directory: Python functions used inside tasks are shipped by value."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_python_backed_queries_from_foreign_cwd(tmp_path):
    script = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {REPO!r})
        import __spark_entry__ as E
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
        q = E.queries()
        for name in ["recent5_timeline", "stream_last10_per_vehicle", "stream_top5_delayed"]:
            print(name, q[name](spark, "/root/testdata/sf0.001").count())
        print("entry", E.entry(spark).count())
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=600, env=env)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "entry 263" in r.stdout
