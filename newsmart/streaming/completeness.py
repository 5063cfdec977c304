"""Landing completeness as a stateful stream (RA-8).

Each landing window has a state of its own: the fullest delivery of each page so far and the total that
its envelopes state. It reports

* ``complete``, as soon as all that the total asks for has landed;
* ``incomplete``, once the watermark (by landing time) passes its deadline, by an event-time timer;
* ``complete_late``, if what was missing lands after that.

Spark's built-in aggregates have no timers of a group's own, so this is a function over a window's
rows in Arrow batches. A window's pages are the state, a few numbers each; a complete window
keeps its status only, so that pages delivered again report nothing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

COMPLETE, INCOMPLETE, LATE = "complete", "incomplete", "complete_late"
OUTPUT = "window_start timestamp, status string, total_results bigint, expected_pages bigint, landed_pages bigint, landed_articles bigint"
STATE = "pages array<int>, counts array<bigint>, total bigint, status string"


def _report(start, status: str, pages: dict[int, int], total: int, page_size: int) -> pd.DataFrame:
    row = (start, status, total, -(-total // page_size), len(pages), sum(pages.values()))
    return pd.DataFrame([row], columns=[c.split()[0] for c in OUTPUT.split(", ")])


def tracker(page_size: int, deadline: dt.timedelta):
    """The state function of one window."""

    def track(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (start,) = key
        numbers, counts, total, status = state.get if state.exists else ([], [], 0, None)
        pages = dict(zip(numbers, counts, strict=True))
        if state.hasTimedOut:
            state.update(([*pages], [*pages.values()], total, INCOMPLETE))
            yield _report(start, INCOMPLETE, pages, total, page_size)
            return
        for some in rows:
            for page, stated, n in zip(some["page"], some["totalResults"], some["n_articles"], strict=True):
                pages[int(page)] = max(int(n), pages.get(int(page), 0))
                total = max(total, int(stated))
        if status in (COMPLETE, LATE):
            return
        if len(pages) >= -(-total // page_size) and sum(pages.values()) >= total:
            done = COMPLETE if status is None else LATE
            state.update(([], [], total, done))
            yield _report(start, done, pages, total, page_size)
            return
        at = int((start + deadline).timestamp() * 1000)
        late = status is None and at <= state.getCurrentWatermarkMs()
        state.update(([*pages], [*pages.values()], total, INCOMPLETE if late else status))
        if late:
            yield _report(start, INCOMPLETE, pages, total, page_size)
        elif status is None:
            state.setTimeoutTimestamp(at)

    return track


def completeness_stream(
    pages: DataFrame, page_size: int = 100, deadline: dt.timedelta = dt.timedelta(hours=2), delay: str = "0 seconds"
) -> DataFrame:
    """Reports on a stream of landed envelopes: ``window_start``, ``page``, ``totalResults``, ``n_articles``
    and ``landed_at``, which moves the watermark. Rows without a window or a page take no part."""
    rows = pages.select(
        F.col("window_start").cast("timestamp").alias("window_start"), "page", F.coalesce("totalResults", F.lit(0)).alias("totalResults"),
        F.coalesce("n_articles", F.lit(0)).alias("n_articles"), F.col("landed_at").cast("timestamp").alias("landed_at"),
    )
    grouped = rows.filter("window_start is not null and page is not null").withWatermark("landed_at", delay).groupBy("window_start")
    reports = grouped.applyInPandasWithState(tracker(page_size, deadline), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return reports.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
