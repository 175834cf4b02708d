"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong patterns (assigned secrets, access ids, long hex) are reported as
they stand.  Weak candidates - account names, short or loosely named
secrets, endpoints - say little alone; one is reported only if parts of
both other kinds (strong ones included) lie within its scope, ``SCOPE``
code points on either side.  The link is an interval join: parts are
summarised per document and every bin of one scope's width that they
cover, and a candidate's interval meets the bins that it reaches into.
The summary keeps the least start and the greatest end inside the bin,
which decides overlap exactly, as an interval is wider than a bin; so
dense documents do not multiply.

Positions come without any Python: a pattern's matches and the pieces
between them (``split``) alternate, and running sums of their lengths give
the offsets in code points.

Defined results: a null or empty text has no spans; matches of a kind are
leftmost and do not overlap, spans of different kinds may; repeated rows
are scanned each on its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm import textwords as W
from webcorpus.session import scratch_path

SCOPE = 240
MASK = "[SECRET]"
_VALUE = r"[A-Za-z0-9+/_.=-]+"
_SET = r"[\"']?\x20*[:=]\x20*[\"']?"

# The strong patterns with the least length of the group that must reach it.
STRONG = {
    "assign": (rf"(?:(?i:password|passwd|secret|token|api_?key)){_SET}({_VALUE})", 8),
    "access": (r"(AKIA[A-Z0-9]+)", 16),
    "hex": (r"([0-9a-f]{32,})", 32),  # a run of 32 or more is always matched whole
}
#: weak candidates by the part of a credential that they are; the group must reach the length
WEAK = {
    "identifier": (rf"(?:(?i:(?:user(?:_?name)?|login|client_?id|account|access_?key_?id)){_SET}([A-Za-z0-9@+/_.=-]+)|(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{{8,}})", 0),
    "secret": (rf"(?i:(?:pwd|pass|pin|passphrase|private_?key|client_?key)){_SET}({_VALUE})", 4),
    "endpoint": (r"(?i:(?:https?|ftps?|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://)([A-Za-z0-9.-]+(?::[0-9]+)?)", 3),
}
#: the part that a strong match plays; a short assigned value is a weak secret
PART = {"assign": "secret", "access": "identifier", "hex": "secret"}
KINDS = [*STRONG, *WEAK]


def _found(text: Column, pattern: str) -> Column:
    """Pieces' lengths, matches' lengths and groups' lengths of one pattern; null without a match."""
    lengths = lambda a: F.transform(a, lambda x: F.char_length(x))
    p = F.lit(pattern)
    return F.when(text.rlike(pattern), F.struct(
        lengths(F.split(text, pattern, -1)).alias("pieces"),
        lengths(F.regexp_extract_all(text, p, F.lit(0))).alias("whole"),
        lengths(F.regexp_extract_all(text, p, F.lit(1))).alias("value")))


def _scanned(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """The kept columns under positional names, a row number and what each pattern found; written, so that numbers hold."""
    text = F.coalesce(W.quoted(text_col).cast("string"), F.lit(""))
    out = docs.select(F.monotonically_increasing_id().alias("row"), *[W.quoted(c).alias(f"c{i}") for i, c in enumerate(keep)],
                      *[_found(text, pattern).alias(kind) for kind, (pattern, _) in (STRONG | WEAK).items()])
    path = scratch_path(docs.sparkSession, "secrets")
    out.write.parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def _matches(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end, value): every match of every pattern."""
    kinds = scanned.select("row", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("f")) for k in KINDS])).alias("k"))
    each = kinds.where("k.f is not null").select(
        "row", F.col("k.kind").alias("kind"),
        F.posexplode(F.arrays_zip(F.col("k.f.pieces").alias("piece"), F.col("k.f.whole").alias("whole"), F.col("k.f.value").alias("value"))).alias("i", "m"))
    running = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.piece") + F.coalesce("m.whole", F.lit(0))).over(running)
    return (each.select("row", "kind", (end - F.coalesce("m.whole", F.lit(0))).alias("start"), end.alias("end"), F.col("m.whole").alias("whole"), F.col("m.value").alias("value"))
            .where("whole is not null").drop("whole"))


def _linked(matches: DataFrame, scope: int) -> DataFrame:
    """(row, kind, start, end) of weak candidates with both complementary parts in scope."""
    strong = F.lit(False)
    for kind, (_, least) in STRONG.items():
        strong = strong | ((F.col("kind") == kind) & (F.col("value") >= least))
    part = F.coalesce(*[F.when(F.col("kind") == k, p) for k, p in PART.items()], F.col("kind"))
    least = F.coalesce(*[F.when(F.col("kind") == k, n) for k, (_, n) in WEAK.items()], F.lit(4))
    parts = matches.withColumn("strong", strong).withColumn("part", part).where(F.col("strong") | (F.col("value") >= least))
    covered = parts.withColumn("bin", F.explode(F.expr(f"sequence(start div {scope}, (end - 1) div {scope})")))
    bins = covered.groupBy("row", "part", "bin").agg(F.min(F.greatest("start", F.col("bin") * scope)).alias("lo"),
                                                     F.max(F.least("end", (F.col("bin") + 1) * scope)).alias("hi"))
    weak = (parts.where("not strong").select("row", F.col("part").alias("kind"), "start", "end")
            .withColumn("bin", F.explode(F.expr(f"sequence(greatest(start - {scope}, 0) div {scope}, (end + {scope}) div {scope})"))))
    near = (weak.join(bins, ["row", "bin"]).where((F.col("part") != F.col("kind")) & (F.col("lo") < F.col("end") + scope) & (F.col("hi") > F.col("start") - scope))
            .groupBy("row", "kind", "start", "end").agg(*[F.max(F.when(F.col("part") == p, 1).otherwise(0)).alias(p) for p in WEAK]))
    others = sum((F.col(p) for p in WEAK), F.lit(0))
    return near.where(others == len(WEAK) - 1).select("row", "kind", "start", "end")


def _spans(scanned: DataFrame, scope: int) -> DataFrame:
    """(row, base, spans): sorted arrays of (start, rank of the kind, kind, end, past: greatest end before it)."""
    matches = _matches(scanned)
    keep = F.lit(False)
    for kind, (_, least) in STRONG.items():
        keep = keep | ((F.col("kind") == kind) & (F.col("value") >= least))
    base = matches.where(keep).select("row", "kind", "start", "end", F.lit(True).alias("base"))
    linked = _linked(matches, scope).select("row", F.concat(F.lit("linked_"), "kind").alias("kind"), "start", "end", F.lit(False).alias("base"))
    every = base.unionByName(linked)
    rank = F.coalesce(*[F.when(F.col("kind") == k, i) for i, k in enumerate([*STRONG, *(f"linked_{k}" for k in WEAK)])])
    every = every.withColumn("rank", rank)
    earlier = Window.partitionBy("row").orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumn("past", F.coalesce(F.max("end").over(earlier), F.lit(0).cast("long")))
    span = F.struct("start", "rank", "kind", "end", "past")
    return every.groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.sort_array(F.collect_list(span)).alias("spans"))


def scan(docs: DataFrame, keep: list[str], *, text_col: str = "text", scope: int = SCOPE,
         names: tuple[str, str] = ("base", "spans")) -> DataFrame:
    """Columns ``keep`` with ``base`` and ``spans`` (or ``names``) for every document: arrays of (start, rank, kind, end, past), maybe empty."""
    scanned = _scanned(docs, keep, text_col)
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,past:bigint>>")
    out = scanned.select("row", *[f"c{i}" for i in range(len(keep))]).join(_spans(scanned, scope), "row", "left")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *[F.coalesce(F.col(c), none).alias(n) for c, n in zip(("base", "spans"), names)])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, *, text_col: str = "text", count_col: str | None = "n_chars", scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """All documents, all columns, with every span of their texts masked and ``count_col`` (if there) set anew."""
    columns = docs.columns
    got = scan(docs, columns, text_col=text_col, scope=scope, names=("__base", "__spans"))
    text = W.quoted(text_col)
    # a span that overlaps earlier ones only extends their mask
    piece = F.transform("__spans", lambda s: F.concat(
        F.substring(text, (s["past"] + 1).cast("int"), F.greatest(s["start"] - s["past"], F.lit(0)).cast("int")),
        F.when(s["start"] >= s["past"], F.lit(mask)).otherwise(F.lit(""))))
    done = F.array_max(F.transform("__spans", lambda s: s["end"]))
    tail = F.substring(text, (done + 1).cast("int"), F.lit(2147483647))
    masked = F.when(F.size("__spans") > 0, F.concat(F.array_join(piece, ""), tail)).otherwise(text)
    out = got.withColumn("__masked", masked)
    cols = []
    for c in columns:
        if c == text_col:
            cols.append(F.col("__masked").alias(c))
        elif c == count_col:
            cols.append(F.when(F.size("__spans") > 0, F.char_length("__masked").cast(docs.schema[c].dataType)).otherwise(W.quoted(c)).alias(c))
        else:
            cols.append(W.quoted(c))
    return out.select(*cols)
