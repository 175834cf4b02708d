"""W1 + W4: the crawl's requeue as one stateful stream.

Each URL is a key of ``transformWithState``: its state holds how often it was
sent back, and whether a page with content was seen.  Fetched pages stream
through in any number of micro-batches and restarts; a challenged page goes
back with its attempt number until ``max_attempts``, whatever the fetcher
remembers.  With ``retry_after`` a timer reports the URL as due again once
that time has passed, so the list of what to fetch comes from the stream
as well.  (Timers keep a query going: use a processing-time trigger with
them; without, ``availableNow`` ends when the input does.)

Only (id, URL, challenged or not) reach the operator: the marker is looked
for natively, and the HTML is neither shuffled nor kept in state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.routing import CHALLENGE_MARKER

OUTPUT = "page_id long, url string, route string, attempt int, visited boolean"
STATE = "attempt int, visited boolean"


class Requeue(StatefulProcessor):
    """Routes of one URL's pages: ``content``, ``retry`` (with the next attempt), ``reject``; ``due`` when a timer ends."""

    def __init__(self, max_attempts: int, retry_after_ms: int | None):
        self.max_attempts, self.retry_after_ms = max_attempts, retry_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("url", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        attempt, visited = self.state.get() if self.state.exists() else (0, False)
        out, sent, content = [], attempt, False
        for part in rows:
            for page_id, challenged in zip(part["page_id"], part["challenged"]):
                # pages of one micro-batch were fetched at the same attempt
                again = attempt + int(challenged)
                route = "content" if not challenged else "retry" if again < self.max_attempts else "reject"
                out.append((page_id, key[0], route, again, visited))
                content |= route == "content"
                sent = max(sent, again) if route == "retry" else sent
        self.state.update((sent, visited or content))
        if self.retry_after_ms is not None and sent > attempt:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retry_after_ms)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempt, visited = self.state.get()
        # a page with content may have come meanwhile
        yield self._frame([] if visited else [(None, key[0], "due", attempt, visited)])

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(rows: list) -> pd.DataFrame:
        names = [c.split()[0] for c in OUTPUT.split(", ")]
        return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "attempt": "int32", "visited": "bool"})


def requeue(pages: DataFrame, marker: str = CHALLENGE_MARKER, max_attempts: int = 3, retry_after_ms: int | None = None) -> DataFrame:
    """A stream of fetched ``(page_id, url, html)`` as ``(page_id, url, route, attempt, visited)``.

    ``attempt``: of a retry, the one that comes next.  ``visited``: whether an
    earlier micro-batch saw a page with content.  Null HTML is content, as in
    ``challenge_split``; null URLs share a key."""
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html").contains(marker), F.lit(False)).alias("challenged"))
    return narrow.groupBy("url").transformWithStateInPandas(
        Requeue(max_attempts, retry_after_ms), outputStructType=OUTPUT, outputMode="append",
        timeMode="None" if retry_after_ms is None else "ProcessingTime")
