"""Corpus building: strip markup, drop blanks, sentences, char tokens, sinks.

One lazy plan per corpus, no shuffle: every step is a per-row native
expression, so a 100 TB input is processed as parallel scans.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..session import make_folder, mounted, remove_path
from ..sources.tables import whole_files
from .parallel import partitioned

#: the tasks, not the driver, put the files of a write in place
IN_TASKS = ("mapreduce.fileoutputcommitter.algorithm.version", "2")
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"
_ODD_IN_NAMES = r"\x01-\x1F\x7F\"#%'*/:=?\\{}\[\]^"

CORPUS_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()),
                              T.StructField("text", T.StringType())])


def strip_markup(df: DataFrame, text_col: str = "html", id_col: str = "page_id",
                 out_col: str = "text") -> DataFrame:
    """T1-T3 over whole documents (no line explode, so no ordering work)."""
    return partitioned(df.select(id_col, text_col), id_col).select(F.col(id_col), TX.strip_markup(text_col).alias(out_col))


def drop_blank(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Keep documents that are not only spaces.

    Written as a 0-or-1-row generator rather than ``where``: a filter on a
    computed text would be inlined by Catalyst (plus an inferred
    ``isnotnull``) and pushed below the projection, evaluating the whole
    markup-stripping chain two more times.  A generator's output cannot be pushed down, so the
    chain runs once per document."""
    keep = F.explode(F.filter(F.array(F.col(text_col)), TX.is_not_blank))
    cols = [F.col(c) if c != text_col else keep.alias(text_col) for c in df.columns]
    return df.select(*cols)


def sentence_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sentence ``(id, sent_no, sentence)``, ``sent_no``
    dense from 0 in text order."""
    return partitioned(df.select(id_col, text_col), id_col).select(
        F.col(id_col), F.posexplode(TX.sentences(text_col)).alias("sent_no", "sentence"))


def char_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One line per sentence with every character followed by a space."""
    s = sentence_rows(df, id_col, text_col)
    return s.select(id_col, "sent_no", TX.char_line("sentence").alias("line"))


def last_by_title(df: DataFrame, title_col: str = "title", content_col: str = "content",
                  order_col: str = "page_id") -> DataFrame:
    """K6: one file per title where equal titles overwrite each other -- the
    last write (highest ``order_col``, unique per row) wins.

    The winner per title is chosen on the narrow ``(title, order)``
    projection (hash aggregate, combined map-side, so a hot title is one
    row per partition before the shuffle); the winning rows are then
    fetched by ``order_col`` with a shuffled hash join, so the wide content
    is shuffled once and never sorted."""
    winners = df.select(title_col, order_col).groupBy(title_col).agg(F.max(order_col).alias(order_col))
    rows = df.select(title_col, order_col, content_col)
    return rows.join(winners.select(order_col).hint("shuffle_hash"), order_col, "left_semi") \
        .select(title_col, order_col, content_col)


def _write_rows(df: DataFrame, folder: str, name_col: str | None) -> None:
    """Text files under a mounted folder, written by the tasks: rows of one
    ``name_col`` folder (escaped already) in one file there, or a file for
    each row without one.  A task that runs again writes the same files again."""
    rows = df.select(*([F.col(name_col).alias("name")] if name_col else []), F.col(df.columns[-1]).alias("text"))

    def run(batches):
        part, out, last, n = TaskContext.get().partitionId(), None, None, 0
        try:
            for batch in batches:
                names = batch.column("name").to_pylist() if name_col else [None] * batch.num_rows
                for name, text in zip(names, batch.column("text")):
                    if out is None or name_col is None or name != last:
                        if out is not None:
                            out.close()
                        if name_col:
                            os.makedirs(f"{folder}/{name}", exist_ok=True)
                        out, last = open(f"{folder}/{name}/part.txt" if name_col else f"{folder}/part-{part:05d}-{n}.txt", "wb"), name
                        n += 1
                    if text.is_valid:
                        out.write(text.as_buffer())
                    out.write(b"\n")
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    rows.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def write_each(df: DataFrame, path: str, text_col: str = "text") -> None:
    """Every row as a text file of its own in a new folder, a newline behind its text.

    On a mounted file system the tasks write the files themselves, which took
    less than half the time of Hadoop's local store.  Other
    stores get Spark's text writer, its tasks putting their files in place
    (the driver would rename them one by one)."""
    spark = df.sparkSession
    if not (folder := mounted(spark, path)):
        return df.select(text_col).write.option("maxRecordsPerFile", 1).option(*IN_TASKS).text(path)
    make_folder(spark, path)
    _write_rows(df.select(text_col), folder, None)


def write_per_file(df: DataFrame, path: str, name_col: str = "file_name", text_col: str = "text",
                   mode: str = "overwrite") -> None:
    """K5: one output per input file, keyed by its name (``name=<file>``
    folders); where a store keeps its files' names cheaper as rows, keep
    ``file_name`` as a column of a parquet table instead.  The files are
    written as :func:`write_each` writes them.
    The text writer ends every row with a newline, so one final ``\n`` is
    taken off first: texts that end in a newline come back unchanged."""
    spark, body = df.sparkSession, F.regexp_replace(F.col(text_col), r"\n\z", "").alias(text_col)
    rows = df.select(F.col(name_col), body).repartition(name_col)
    folder = mounted(spark, path) if mode == "overwrite" else None
    if not folder:
        return rows.write.mode(mode).option(*IN_TASKS).partitionBy(name_col).text(path)
    remove_path(spark, path)
    make_folder(spark, path)
    # the folder names of a table partitioned by name: odd characters escaped, none for a null
    name = F.col(name_col).cast("string")
    pieces = F.transform(F.regexp_extract_all(name, F.lit(rf"(?s)[{_ODD_IN_NAMES}]|[^{_ODD_IN_NAMES}]+"), F.lit(0)),
                         lambda p: F.when(p.rlike(f"^[{_ODD_IN_NAMES}]$"), F.concat(F.lit("%"), F.hex(p))).otherwise(p))
    name = F.when(name != "", F.array_join(pieces, "")).otherwise(F.lit(_NO_NAME))
    name = F.concat(F.lit(f"{name_col}="), F.coalesce(name, F.lit(_NO_NAME))).alias("_folder")
    _write_rows(rows.select(name, text_col).sortWithinPartitions("_folder"), folder, "_folder")


def read_per_file(spark, path: str, name_col: str = "file_name", text_col: str = "text") -> DataFrame:
    """K5: what :func:`write_per_file` wrote, one row per file with the name it
    was written under (null for a null or empty one) and its bytes as they are.

    On a mounted file system tasks list and read the folders; Spark's reader would hold
    every folder and file of them in the driver's memory, as it does for other stores."""
    if not (folder := mounted(spark, path)):
        return spark.read.text(path, wholetext=True).select(F.col(name_col).cast("string").alias(name_col), F.col("value").alias(text_col))

    def name_of(name):
        value = name.removeprefix(f"{name_col}=")
        return None if value == _NO_NAME else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)
    return whole_files(spark, folder, name_of, in_folders=True).toDF(name_col, text_col)


def write_json_corpus(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none",
                      max_records_per_file: int = 1_000_000) -> None:
    """JSON Lines, UTF-8 kept (no \\u escapes), written by the
    executors in parallel -- the corpus never passes through the driver.
    JSON Lines can be split at any line only while they are not compressed,
    so that is the default; a file holds at most ``max_records_per_file``
    documents for the sake of readers that take whole files."""
    (df.write.mode(mode).option("compression", compression)
       .option("maxRecordsPerFile", max_records_per_file).json(path))


def preview(df: DataFrame, order_cols: list[str], n: int = 2) -> DataFrame:
    """A3: the first ``n`` rows in an explicit order (a top-n, so the limit
    is the feature; Spark plans it as TakeOrderedAndProject)."""
    return df.orderBy(*order_cols).limit(n)


def read_json_corpus(spark, path: str, schema: T.StructType = CORPUS_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)
