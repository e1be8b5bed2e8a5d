"""Dates that close by themselves: a stream of landed pages, and per date and route what has come.

The state of a date and route is small: the announced total and the merged ranges of row
numbers. The rows themselves stay where they landed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SPANS = "date string, route_no string, total bigint, start bigint, n bigint"
EVENTS = "date string, route_no string, event string, landed bigint, total bigint"
STATE = "total bigint, closed boolean, starts array<bigint>, ends array<bigint>"


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges (first, last) in order, those that touch or overlap made one."""
    merged: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(merged[-1][1], last))
        else:
            merged.append((first, last))
    return merged


def _step(key: tuple, pages: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    total, closed, starts, ends = state.get if state.exists else (None, False, [], [])
    ranges = list(zip(starts, ends))
    came = 0
    for batch in pages:
        told = batch["total"].dropna()
        if len(told):
            total = max(int(told.max()), total or 0)
        for start, n in zip(batch["start"], batch["n"]):
            if n > 0:
                came += 1
                ranges.append((int(start), int(start) + int(n) - 1))
    ranges = merge_ranges(ranges)
    landed = sum(last - first + 1 for first, last in ranges)
    whole = total is not None and (total == 0 or bool(ranges) and ranges[0][0] <= 1 and ranges[0][1] >= total)
    event = "late" if closed and came else "closed" if whole and not closed else None
    state.update((total, bool(closed or whole), [f for f, _ in ranges], [last for _, last in ranges]))
    if event:
        yield pd.DataFrame([(*key, event, landed, total)], columns=["date", "route_no", "event", "landed", "total"])


def closing_dates(spans: DataFrame) -> DataFrame:
    """Events of a stream of page spans (`SPANS`): `closed` once all announced rows of a date and route came.

    A page that comes after that makes a `late` event, which asks for the date to be built
    again: its rows may correct earlier ones. A failed page has no rows, one that lands
    twice counts once, and a repeated batch leaves the state as it is.
    """
    return spans.groupBy("date", "route_no").applyInPandasWithState(
        _step, EVENTS, STATE, "append", GroupStateTimeout.NoTimeout
    )


def follow(spans: DataFrame, out: str, checkpoint: str) -> None:
    """Append the events of all spans that landed since the last call to the table `out`, then stop."""
    query = (
        closing_dates(spans).writeStream.format("parquet").outputMode("append")
        .trigger(availableNow=True).option("checkpointLocation", checkpoint).start(out)
    )
    query.awaitTermination()
