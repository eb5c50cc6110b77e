"""Task code must reach executors that do not have the package on their path."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_udfs_run_where_workers_cannot_import_the_package(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})          # the driver sees the package, workers do not
        from pyspark.sql import SparkSession, functions as F
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        from vellum.operators.extract import decoded_content
        from vellum.sources.stage import upload, list_stage
        df = spark.createDataFrame([(b"plain words",)], "c binary")
        got = df.select(decoded_content(F.col("c")).alias("p")).collect()[0].p
        assert got.pages == ["plain words"], got
        files = spark.createDataFrame([("a/b.pdf", "hello", None)], "relative_path string, content string, last_modified timestamp_ntz")
        assert upload(files, {str(tmp_path / 'stage')!r}) == 1
        assert [r.relative_path for r in list_stage(spark, {str(tmp_path / 'stage')!r}).collect()] == ["a/b.pdf"]
        print("SHIPPED-OK")
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=300)
    assert "SHIPPED-OK" in out.stdout, out.stderr[-3000:]
