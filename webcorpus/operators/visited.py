"""Visited sets as a DataFrame ``(meta, key)``: first-seen, forget,
membership, reconciliation against stored records, re-keying.

Every operator is a join or aggregate on ``(meta, key)``.  Duplicates are
collapsed with partial aggregates (combined map-side before the shuffle),
so a key or a set holding a third of all rows does not land whole in one
task; large anti/semi joins are sort-merge joins with AQE's skew split.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import list_names, make_folder, qualified, read_text, remove_path, write_new

SET_COLS = ["meta", "key"]


def keyed(df: DataFrame, url_col: str = "url", meta: str | None = None,
          suffix: str = U.KEY_SUFFIX) -> DataFrame:
    """Add ``key`` (U1) and, if given, a constant ``meta``; ineligible URLs
    (P4: not http(s), or not exactly one suffix) are dropped here, before
    any shuffle."""
    out = keyed_all(df, url_col, suffix)
    if meta is not None:
        out = in_set(out, meta)
    return out.where(F.col("key").isNotNull())


def keyed_all(df: DataFrame, url_col: str = "url", suffix: str = U.KEY_SUFFIX) -> DataFrame:
    """Add ``key`` (U1) to every row, null for an ineligible URL."""
    return df.withColumn("key", U.visit_key(url_col, suffix))


def in_set(df: DataFrame, meta: str) -> DataFrame:
    """Add the constant ``meta`` to rows that have their ``key``."""
    # a name that the optimizer does not take for a constant: as one it would leave the join keys, and
    # a set stored in buckets of (meta, key) would be shuffled
    return df.withColumn("meta", F.concat(F.substring("key", 1, 0), F.lit(meta)))


def first_seen(candidates: DataFrame, visited: DataFrame | None = None,
               order_cols: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The first arrival of every ``(meta, key)`` that is not yet in
    ``visited``, as ``(meta, key, *order_cols)``.  "First" is the smallest
    ``order_cols`` (one or two columns of whole numbers, dates or
    timestamps, unique together), so the survivor is deterministic.  Null
    keys are not candidates.

    The order is one fixed-width number, so the minimum is taken in a hash
    aggregate on either side of the shuffle and no row is sorted.  Fetch
    other columns by the order columns (``with_rows``)."""
    order = order_number(candidates, order_cols)
    c = candidates.where(F.col("key").isNotNull() & F.col("meta").isNotNull()).withColumn("_order", order)
    first = c.groupBy(*SET_COLS).agg(*[F.min_by(o, "_order").alias(o) for o in order_cols])
    if visited is not None:
        first = first.join(visited.select(*SET_COLS).where(F.col("key").isNotNull()), SET_COLS, "left_anti")
    return first


def order_number(df: DataFrame, cols: tuple[str, ...]) -> Column:
    """One or two columns as one number with the same order (two 64-bit
    numbers side by side in a decimal; beyond +-5e18 the first overflows
    and raises)."""
    kinds = dict(df.dtypes)

    def number(c: str) -> Column:
        x = F.col(c)
        if kinds[c].startswith("timestamp"):
            x = F.unix_micros(x.cast("timestamp"))
        elif kinds[c] == "date":
            x = F.unix_date(x)
        return x.cast("bigint")
    if len(cols) == 1:
        return number(cols[0])
    a, b = cols
    wide = number(a).cast("decimal(19,0)") * F.lit(2 * 10**18).cast("decimal(19,0)")
    return (wide * F.lit(10).cast("decimal(2,0)")).cast("decimal(38,0)") + number(b).cast("decimal(20,0)")


def with_rows(first: DataFrame, candidates: DataFrame, order_cols: tuple[str, ...]) -> DataFrame:
    """The candidate rows that :func:`first_seen` chose, all columns."""
    on = [*SET_COLS, *order_cols]
    return candidates.join(first.select(*on).hint("shuffle_hash"), on, "left_semi")


def first_seen_rows(candidates: DataFrame, visited: DataFrame | None = None,
                    id_col: str = "page_id") -> DataFrame:
    """D1 for wide rows (pages carrying their HTML): the same choice as
    ``first_seen`` with ``order_cols=(id_col,)``, planned so the wide rows
    are never sorted.  Winners are picked on the narrow ``(meta, key, id)``
    projection (hash aggregate, combined map-side), anti-joined with the
    set, and the winning rows are fetched with a shuffled hash join on
    ``id_col``: the HTML crosses one shuffle and is streamed past a hash
    table of winner ids.  Rows that share key and id (one page fetched twice in a
    batch) come out together; drop all but one where they are narrow."""
    c = candidates.where(F.col("key").isNotNull() & F.col("meta").isNotNull())
    winners = c.select(*SET_COLS, id_col).groupBy(*SET_COLS).agg(F.min(id_col).alias(id_col))
    if visited is not None:
        winners = winners.join(visited.select(*SET_COLS).where(F.col("key").isNotNull()), SET_COLS, "left_anti")
    return c.join(winners.hint("shuffle_hash"), [*SET_COLS, id_col], "left_semi")


def members(visited: DataFrame, meta: str) -> DataFrame:
    """S7 + T11: the distinct members of one named set; keys stored as
    bytes are decoded from UTF-8."""
    k = F.col("key")
    if dict(visited.dtypes)["key"] == "binary":
        k = F.decode(k, "UTF-8")
    return visited.where(F.col("meta") == meta).select("meta", k.alias("key")).distinct()


def snapshot(visited: DataFrame, base_path: str, version: str) -> str:
    """K7: persist the sets under a new versioned path, partitioned by set
    name.  Readers switch to the new version only after the write has
    succeeded, so a failed write never leaves a half-replaced set."""
    path = f"{base_path.rstrip('/')}/version={version}"
    visited.select(*SET_COLS).write.mode("errorifexists").partitionBy("meta").parquet(path)
    return path


class VisitedTable:
    """A visited set in bucketed files under a folder, versions named by manifests.

    Every write makes a new segment, ``data/seg=<id>``, bucketed by
    ``(meta, key)``; it belongs to the set once the next manifest,
    ``manifest/<version>``, names it.  A manifest is written whole under
    another name and then renamed, which fails if that version exists, so
    of two writers one sees the other's version and bases its own on it.
    A job that dies between data and manifest leaves the old version, and
    its files are never read.  Nothing else holds state: another process
    that opens the folder finds the set, whatever its catalog.

    An anti-join with the set shuffles the batch only: the history is read
    bucket by bucket.  A key stored twice is still one member; ``compact``
    rewrites the set as one segment, ``vacuum`` deletes the segments that no
    kept version names.  ``versions`` and ``read(version)`` give earlier
    states.  The number of buckets is the folder's, set by its first writer.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def versions(self) -> list[int]:
        """All committed versions, oldest first."""
        return sorted(int(name) for name in list_names(self.spark, f"{self.path}/manifest") if name.isdigit())

    def _manifest(self, version: int | None = None) -> dict | None:
        known = self.versions()
        if version is None:
            if not known:
                return None
            version = known[-1]
        elif version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        return json.loads(read_text(self.spark, f"{self.path}/manifest/{version:010d}"))

    def _commit(self, change: Callable[[list[str]], list[str]], buckets: int) -> int:
        """The next version, its segments made of the current ones; tried again if another writer was faster."""
        while True:
            now = self._manifest()
            version = now["version"] + 1 if now else 0
            if now and now["buckets"] != buckets:
                raise ValueError(f"{self.path} has {now['buckets']} buckets, the segment {buckets}")
            body = json.dumps({"version": version, "buckets": buckets, "segments": change(now["segments"] if now else [])})
            if write_new(self.spark, f"{self.path}/manifest/{version:010d}", body):
                return version

    def _table(self, buckets: int) -> str:
        """Name of the folder in this session's catalog, which tells Spark its buckets and nothing else."""
        where = qualified(self.spark, f"{self.path}/data")
        name = "visited_" + hashlib.sha256(f"{where} {buckets}".encode()).hexdigest()[:24]
        make_folder(self.spark, where)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (meta STRING, key STRING, seg STRING) USING parquet PARTITIONED BY (seg) "
                       f"CLUSTERED BY (meta, key) INTO {buckets} BUCKETS LOCATION '{where}'")
        return name

    def read(self, version: int | None = None) -> DataFrame | None:
        """The members of a version (None: the newest), or None if nothing has been stored yet."""
        m = self._manifest(version)
        if m is None:
            return None
        name = self._table(m["buckets"])
        if m["segments"]:  # those that other processes have written are new to this catalog
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION (seg = '{seg}')" for seg in m["segments"]))
            self.spark.catalog.refreshTable(name)
        return self.spark.table(name).where(F.col("seg").isin(m["segments"])).select(*SET_COLS)

    def _segment(self, keys: DataFrame, buckets: int) -> str:
        seg = uuid.uuid4().hex
        (keys.select(*SET_COLS).repartition(buckets, *SET_COLS).withColumn("seg", F.lit(seg)).write.mode("append").format("parquet")
             .partitionBy("seg").bucketBy(buckets, *SET_COLS).saveAsTable(self._table(buckets)))
        return seg

    def append(self, keys: DataFrame) -> int:
        """Store keys; the version that holds them."""
        now = self._manifest()
        buckets = now["buckets"] if now else self.buckets
        seg = self._segment(keys, buckets)
        return self._commit(lambda segments: [*segments, seg], buckets)

    def compact(self) -> int | None:
        """One segment without repeats in place of those there are; segments stored meanwhile stay."""
        now = self._manifest()
        if now is None:
            return None
        old = set(now["segments"])
        seg = self._segment(self.read(now["version"]).distinct(), now["buckets"])
        return self._commit(lambda segments: [seg, *[s for s in segments if s not in old]], now["buckets"])

    def drop(self) -> None:
        """Delete the set and its history."""
        for m in filter(None, [self._manifest()]):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(m['buckets'])}")
        remove_path(self.spark, self.path)

    def vacuum(self, keep: int = 2) -> None:
        """Delete all but the ``keep`` newest versions and the segments that none of those names.

        For a time without writers: a segment that awaits its manifest would go, too."""
        known = self.versions()
        if not known:
            return
        kept = {s for v in known[-keep:] for s in self._manifest(v)["segments"]}
        for v in known[:-keep]:
            remove_path(self.spark, f"{self.path}/manifest/{v:010d}")
        for name in list_names(self.spark, f"{self.path}/data"):
            if name.startswith("seg=") and name.removeprefix("seg=") not in kept:
                remove_path(self.spark, f"{self.path}/data/{name}")


def mark(visited: DataFrame, new_keys: DataFrame) -> DataFrame:
    """Add keys to a set (idempotent): the union, distinct on (meta, key)."""
    return visited.select(*SET_COLS).unionByName(new_keys.select(*SET_COLS)).distinct()


def forget_keys(visited: DataFrame, forget: DataFrame) -> DataFrame:
    """D2 (intended form): remove the given keys from their sets."""
    return visited.join(forget.select(*SET_COLS).where(F.col("key").isNotNull()), SET_COLS, "left_anti")


def is_member(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """D3: ``candidates`` plus a boolean ``is_member`` column (null keys are
    never members).  The set side is made distinct first, so the left join
    cannot multiply rows."""
    s = visited.select(*SET_COLS).where(F.col("key").isNotNull()).distinct().withColumn("_m", F.lit(True))
    return (candidates.join(s, SET_COLS, "left")
            .withColumn("is_member", F.coalesce(F.col("_m"), F.lit(False))).drop("_m"))


def stored_keys(stored: DataFrame, url_col: str = "url", suffix: str = U.KEY_SUFFIX) -> DataFrame:
    """S4 + U1: the distinct keys of a stored table's URL column."""
    return (stored.select(U.strip_key_prefix(url_col, suffix).alias("key"))
                  .where(F.col("key").isNotNull()).distinct())


def reconcile(visited: DataFrame, stored: DataFrame, meta: str | None = None,
              url_col: str = "url", suffix: str = U.KEY_SUFFIX) -> DataFrame:
    """Compare a visited set with the stored records.  Returns every
    member with ``status`` = ``kept`` (a stored record has its key) or
    ``stale`` (nothing stored: the key must be forgotten).  Both sides go
    through the same key rule, so full URLs and bare keys compare equal.
    The new version of the set is ``where(status = 'kept')``."""
    v = visited.where(F.col("key").isNotNull())
    if meta is not None:
        v = v.where(F.col("meta") == meta)
    v = v.select("meta", U.strip_key_prefix("key", suffix).alias("key")).distinct()
    s = stored_keys(stored, url_col, suffix).withColumn("_s", F.lit(True))
    return (v.join(s, "key", "left")
             .select("meta", "key", F.when(F.col("_s"), F.lit("kept")).otherwise(F.lit("stale")).alias("status")))


def rekey(visited: DataFrame, suffix: str = U.KEY_SUFFIX) -> DataFrame:
    """Strip the ``….net/`` prefix from every member; members that are
    already bare keys are kept as they are.  Distinct on (meta, key)."""
    return visited.select("meta", U.strip_key_prefix("key", suffix).alias("key")).distinct()


def frontier_union(*producers: DataFrame) -> DataFrame:
    """D6 + P7: UNION ALL of ``(meta, url, ...)`` producers, empty URLs
    dropped.  Duplicates stay; ``first_seen`` removes them."""
    out = None
    for p in producers:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out.where(F.col("url").isNotNull() & (F.col("url") != ""))
