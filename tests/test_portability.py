"""The driver may run the entry points from any directory, with a plain
session: Python workers must still import the package."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_points_from_foreign_cwd(tmp_path):
    script = textwrap.dedent(
        f"""
        import os, sys
        sys.path.insert(0, {REPO!r})
        import __spark_entry__ as E
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        print("ENTRY", E.entry(spark).count())
        print("PUMP", E.queries()["pump_and_dump"](spark, "/root/testdata/sf0.001").count())
        from candlewick.streaming import queries as Q
        from candlewick.streaming.detectors import stream_alerts
        os.makedirs("feed")
        open("feed/a.json", "w").write('{{"symbol":"A","trade_id":1,"price":1.0,"quantity":1.0,"trade_time_ms":1000}}\\n')
        q = (stream_alerts(Q.parse_trades(Q.read_text_values(spark, "feed"))).writeStream.format("noop")
             .option("checkpointLocation", "ck").trigger(availableNow=True).start())
        q.awaitTermination()
        print("STREAM ok")
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    out = res.stdout
    assert res.returncode == 0, res.stderr[-3000:]
    assert "ENTRY 248" in out and "PUMP 23" in out and "STREAM ok" in out
