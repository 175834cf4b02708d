"""Sources: page tables, stored record tables, text folders, SQL reads."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Callable
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.parallel import dealt
from ..session import mounted, table_path

PAGE_SCHEMA = T.StructType([T.StructField("page_id", T.LongType()),
                            T.StructField("url", T.StringType()),
                            T.StructField("html", T.StringType())])


# files that Spark's reader unpacks by their names
_PACKED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst")
#: bytes of text a task holds besides the file it reads
_READ_AT_ONCE = 8 << 20

# a page as a crawl step gets it: with the number of failed attempts so far
FETCHED_SCHEMA = T.StructType([*PAGE_SCHEMA.fields, T.StructField("attempt", T.IntegerType())])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table; select columns afterwards and the scan reads only
    those (``ReadSchema``), filters reach it as ``PushedFilters``."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages ``(page_id, url, html)``; one row per page."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def _is_data(name: str) -> bool:
    """Whether Spark's readers take a file or folder of this name for data."""
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def _url_name(name: str) -> str:
    """A file's name as ``_metadata.file_name`` has it: what a URI's path may not hold is escaped."""
    return re.sub(r"[^\w!.~'()*:@&=+$,;\x80-\U0010FFFF-]|[\x80-\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]", lambda m: quote(m[0], safe=""), name)


def whole_files(spark: SparkSession, folder: str, name_of: Callable[[str], str | None], in_folders: bool = False) -> DataFrame:
    """The files of a mounted folder, or of the folders in it, one row per
    file: ``(name, value)``, what ``name_of`` makes of the name of the file or of its
    folder, and the file's bytes as they are.  As with Spark's reader, hidden and empty files are none.

    ``spark.read`` holds every file's status, split and task in the driver's
    memory.  Here one task streams the folder's names, and the tasks they are dealt
    out to read the files: the driver holds nothing for a file."""
    def names(_):
        with os.scandir(folder) as entries:
            found = (e.name for e in entries if _is_data(e.name))
            while some := [*itertools.islice(found, 5000)]:
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], names=["name"])

    def files(name):
        if not in_folders:
            return [f"{folder}/{name}"]
        return [f"{folder}/{name}/{x}" for x in sorted(os.listdir(f"{folder}/{name}")) if _is_data(x)]

    def rows(of, texts):
        # not checked for being UTF-8, as Spark's reader does not either
        return pa.RecordBatch.from_arrays([pa.array(of, pa.string()), pa.array(texts, pa.binary()).view(pa.string())], names=["name", "value"])

    def read(batches):
        of, texts, held = [], [], 0
        for name in (x for batch in batches for x in batch.column("name").to_pylist()):
            for path in files(name):
                if path.endswith(_PACKED):
                    raise ValueError(f"{path} is compressed: its folder takes Spark's reader")
                with open(path, "rb") as f:
                    text = f.read()
                if text:
                    of.append(name_of(name))
                    texts.append(text)
                    held += len(text)
                if held >= _READ_AT_ONCE:
                    yield rows(of, texts)
                    of, texts, held = [], [], 0
        if of:
            yield rows(of, texts)

    listed = spark.range(0, 1, 1, 1).mapInArrow(names, "name string")
    return dealt(listed, "name").mapInArrow(read, "name string, value string")


def _plain_folder(spark: SparkSession, path: str) -> str | None:
    """The path as tasks can open it, if it is a mounted folder of plain files only; its names are streamed, not held."""
    folder = None if re.search(r"[*?{}\[\]\\]", path) else mounted(spark, path)
    if not folder or not os.path.isdir(folder):
        return None
    with os.scandir(folder) as entries:
        plain = all(e.is_file() and not e.name.endswith(_PACKED) for e in entries if _is_data(e.name))
    return folder if plain else None


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """A folder of text files, one row per file ``(file_name, text)``.

    Whole files (``wholetext``) so line order never needs restoring; line
    ends are normalised to ``\\n`` as Python's text mode reads them.  A mounted
    folder of plain files is read by :func:`whole_files`; patterns, compressed files, folders
    in folders and other stores by Spark's reader, which lists all files in the driver."""
    if folder := _plain_folder(spark, path):
        df = whole_files(spark, folder, _url_name).withColumnRenamed("name", "file_name")
    else:
        df = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), "value")
    return df.select("file_name", F.regexp_replace("value", r"\r\n?", "\n").alias("text"))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              num_partitions: int, columns: list[str] | None = None, properties: dict | None = None) -> DataFrame:
    """S3: a stored table over JDBC, read in parallel ranges of
    ``partition_column`` and fetched 6,000 rows at a time.  Without a range
    column the whole table would come through one task, so it is demanded."""
    props = {"fetchsize": "6000", **(properties or {})}
    df = spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                         numPartitions=num_partitions, properties=props)
    return df.select(*columns) if columns else df


def sql_single_row(spark: SparkSession, sql: str) -> DataFrame:
    """S8 (single-row form): the statement must return exactly one row;
    anything else raises.  It runs once: at most two rows are fetched, and
    the result is made of the row that was checked."""
    df = spark.sql(sql)
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one row, got {'none' if not rows else 'more than one'}")
    return spark.createDataFrame(rows, df.schema)


def sql_rows(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """S8 (all-rows form): every row of the statement, lazily, as Spark plans it.

    ``tables`` are named in the statement as ``{name}``; nothing is
    registered or fetched."""
    return spark.sql(sql, **tables)
