"""Defragmenting streams: fragments of a message wait for each other, then come out whole."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "identifier string, n int, content string, complete boolean"


def defragment(stream: DataFrame, wait: str = "10 minutes") -> DataFrame:
    """identifier, n, content: a row once all `count` fragments of an identifier are there (columns identifier, number, count, ts, content), in order of number.

    Fragments later than the watermark are lost; an identifier that stays incomplete past it comes out as it is, with complete = false.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[int, str] = dict(zip(*state.get, strict=True)) if state.exists else {}
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], len(held), "".join(held[k] for k in sorted(held)), False)], columns=["identifier", "n", "content", "complete"])
            return
        total = None
        for f in frames:
            held.update(zip(f["number"].tolist(), f["content"].tolist(), strict=True))
            total = int(f["count"].max()) if len(f) else total
        if total is not None and len(held) >= total:
            if state.exists:
                state.remove()
            yield pd.DataFrame([(key[0], len(held), "".join(held[k] for k in sorted(held)), True)], columns=["identifier", "n", "content", "complete"])
        else:
            state.update((list(held), list(held.values())))
            state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + 1)

    return stream.withWatermark("ts", wait).groupBy("identifier").applyInPandasWithState(run, OUT, "numbers array<int>, contents array<string>", "append", GroupStateTimeout.EventTimeTimeout)


def windowed_counts(stream: DataFrame, window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events (ts, event_type, value) by tumbling window."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
