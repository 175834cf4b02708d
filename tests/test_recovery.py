"""A Python worker dies in the middle of an extraction job: Spark retries
the task and the written output is whole, with no duplicates.

Runs in its own process because task retries need a ``local[n, retries]``
master (the shared test session allows no retries)."""

import os
import subprocess
import sys
import tempfile
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import os, sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession
    from pyspark.sql import types as T
    from webcorpus.operators import extract as X

    marker = {marker!r}

    def crash_once(url, root, html):
        # the first attempt to reach page 7 kills its Python worker
        if url.endswith("/7") and not os.path.exists(marker):
            open(marker, "w").close()
            os._exit(1)
        yield {{"n_tags": str(sum(1 for _ in root.iter()))}}

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = pages.selectExpr("page_id", "concat('https://x.net/', page_id) AS url", "html")
    rule = X.Rule("crash", T.StructType([T.StructField("n_tags", T.StringType())]), crash_once)
    X.extract(pages, rule).write.mode("overwrite").parquet({out!r})
    got = spark.read.parquet({out!r})
    print("RESULT", got.count(), got.select("page_id").distinct().count(), pages.count(),
          os.path.exists(marker))
""")


def test_worker_loss_is_retried_and_output_is_whole():
    tmp = tempfile.mkdtemp(prefix="webcorpus-recovery-")
    script = SCRIPT.format(root=ROOT, marker=os.path.join(tmp, "crashed"), out=os.path.join(tmp, "out"))
    proc = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT")]
    assert lines, proc.stderr[-2000:]
    _, rows, distinct_ids, pages, crashed = lines[0].split()
    assert crashed == "True"                       # the failure really happened
    assert rows == distinct_ids == pages           # every page once, none twice
