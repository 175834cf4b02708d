"""A Python worker dies in the middle of packing: its task runs again and the sequences are whole.

In a process of its own, since task retries need a ``local[n, retries]`` master."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = textwrap.dedent("""
    import os, sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession, functions as F
    from webcorpus.llm import packing

    marker = {marker!r}

    class Crashing(packing.Encoder):
        def ids(self, text):
            if text.startswith("doc 700 ") and not os.path.exists(marker):
                open(marker, "w").close()
                os._exit(1)
            return super().ids(text)

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    docs = spark.range(0, 1000, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("doc "), "id", F.lit(" "), F.repeat(F.lit("word "), 300)).alias("text"))
    packing.Encoder = Crashing
    packing.pack(docs).write.parquet({out!r})
    got = spark.read.parquet({out!r})
    per_doc = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    print("RESULT", os.path.exists(marker), per_doc.count(), per_doc.where("n != all").count(),
          got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count())
""")


def test_worker_loss_leaves_whole_sequences(tmp_path):
    script = SCRIPT.format(root=ROOT, marker=str(tmp_path / "crashed"), out=str(tmp_path / "out"))
    proc = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, env=os.environ | {"PYTHONPATH": ROOT})
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT")]
    assert lines, proc.stderr[-2000:]
    assert lines[0].split()[1:] == ["True", "1000", "0", "0"]
