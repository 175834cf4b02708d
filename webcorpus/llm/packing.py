"""Packing of documents into training sequences by Karmarkar-Karp differencing.

A document's token ids (and an end id) are cut into full windows and into
remainders that are halved into pieces.  Pieces are gathered until
they fill a number of windows but for a small slack, and the differencing
method deals them out: the two partial partitions with the largest spread
are merged again and again, the fullest windows of one with the emptiest
of the other, until one partition with near-equal windows is left.  If a
window exceeds the capacity, the number of windows rises by one.

Tokenising and packing run where a document is read; nothing is shuffled.
A task works through bounded groups, so memory does not grow with the
table.  Sequence ids combine the task's partition and a running number.

The ids are those of the byte-level BPE vocabulary.  They are computed with
a faster library over the same ranks; a text that contains a special
token's string, or a blank run too long for that library's pattern matcher,
goes through the ``tokenizers`` library itself.

Defined results: a null or empty text is its end id alone; repeated rows
are packed each on its own; an empty table gives no sequences.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import textwords as W

WINDOW = 2048
MAX_PIECE, LEAST_PIECE = 1024, 32   # a remainder is halved from one to the other: unlike sizes balance best
GROUP = 32            # windows dealt out together
SLACK = 8             # ids left free per window, so that near-equal windows fit
END_ID = 1
FIELDS = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
])


class Encoder:
    """Token ids of texts, as ``tokenizers`` gives them without adding special tokens."""

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        try:
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype=np.uint32)
        except ValueError:  # its pattern matcher gives up on very long blank runs
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def vocabulary_files(name: str = "byte_bpe_50k") -> tuple[str, str, str]:
    """Vocabulary, ranks and split pattern of the public tokenizer; looked up where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: ``sizes`` dealt to ``k`` windows with near-equal sums; indices per window."""
    # a partial partition: its non-empty windows, fullest first, as (sum, indices as nested pairs)
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        a = heapq.heappop(heap)[2]
        b = heapq.heappop(heap)[2]
        if len(a) < len(b):
            a, b = b, a
        # the emptiest windows of one take the fullest of the other
        room = k - len(a)
        free, meet = b[:room], b[room:]
        if meet:
            n = len(meet)
            low = a[len(a) - n:]
            joined = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(reversed(low), meet)]
            if room:  # full windows of the other that found room stand on their own
                joined += free
            windows = a[:len(a) - n] + joined
        else:
            windows = a + free
        windows.sort(key=lambda w: -w[0])
        spread = windows[0][0] - (windows[-1][0] if len(windows) == k else 0)
        heapq.heappush(heap, (-spread, tick, windows))
        tick += 1
    out = []
    for _, tree in (heap[0][2] if heap else []):
        members, stack = [], [tree]
        while stack:
            for x in stack.pop():
                (members if isinstance(x, int) else stack).append(x)
        out.append(sorted(members))
    return out


def deal(sizes: list[int], window: int) -> list[list[int]]:
    """Windows of at most ``window``; their number rises until all fit."""
    k = max(1, -(-sum(sizes) // window))
    while True:
        dealt = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= window for w in dealt):
            return dealt
        k += 1


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", files=vocabulary_files, window: int = WINDOW,
         max_piece: int = MAX_PIECE, least_piece: int = LEAST_PIECE, group: int = GROUP, slack: int = SLACK, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col`` and :data:`FIELDS`; ``ids`` are little-endian unsigned 32-bit."""
    src = docs.select(W.quoted(id_col).alias("id"), F.coalesce(W.quoted(text_col).cast("string"), F.lit("")).alias("text"))
    out = T.StructType([T.StructField("id", src.schema["id"].dataType), *FIELDS])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, encoder = to_arrow_schema(out), Encoder(*files())
        sequence = TaskContext.get().partitionId() << 33
        rows, held, total = [], [], 0  # rows to write; remainders waiting: (id, start, ids, doc_tokens)

        def flush():
            cols = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

        def dealt():
            nonlocal sequence, total
            for members in deal([len(p[2]) for p in held], window):
                at = 0
                for i in members:
                    doc, start, ids, n = held[i]
                    rows.append((doc, start, len(ids), ids.tobytes(), n, sequence, at))
                    at += len(ids)
                sequence += 1
            held.clear()
            total = 0

        room = group * (window - slack)
        for batch in W.regroup(batches, 1, 4 << 20):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encoder.ids(text), np.uint32(end_id)).astype("<u4")
                n, start = len(ids), 0
                while n - start >= window:
                    rows.append((doc, start, window, ids[start:start + window].tobytes(), n, sequence, 0))
                    sequence += 1
                    start += window
                while start < n:
                    left = n - start
                    size = min(left if left <= least_piece else min(max_piece, -(-left // 2)), room - total)
                    held.append((doc, start, ids[start:start + size], n))
                    start, total = start + size, total + size
                    if total == room:
                        dealt()
                if len(rows) >= 4096:
                    yield flush()
        if held:
            dealt()
        if rows:
            yield flush()

    return src.mapInArrow(run, out).withColumnRenamed("id", id_col)
