"""Batch windows and landing completeness (RA-7, RA-8, DAT-6/7, MTH-1).

The reference requests articles per time window: 50 daily windows for a backfill,
the hour one day back for the hourly job, and today's window. Here the windows are a
small DataFrame (its size is the number of windows asked for) and an article is counted
once, whatever the number of windows that hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsmart.functions import iso_format, page_count
from newsmart.functions.columns import as_col


def _dt_interval(days: int = 0, hours: int = 0, minutes: int = 0, seconds: int = 0) -> Column:
    return F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(seconds))


def backfill_windows(spark: SparkSession, last_day: Column, days: int = 50) -> DataFrame:
    """``days`` daily windows ``[d 00:00:00, d 23:59:59]`` for the days ending at
    ``last_day`` (a date expression, e.g. a scalar subquery over the data).

    ``last_day`` is referenced once, in its own projection, so a subquery behind it
    runs once rather than once per use."""
    days_df = spark.range(days).select(F.date_sub(last_day.cast("date"), F.col("id").cast("int")).alias("day"))
    day = F.col("day")
    start = F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), F.lit(0), F.lit(0), F.lit(0))
    return days_df.select(start.alias("window_start")).select(
        "window_start", (F.col("window_start") + _dt_interval(0, 23, 59, 59)).alias("window_end")
    )


def past_hour_window(spark: SparkSession, now: Column, lag_hours: int = 24) -> DataFrame:
    """The hourly job's window: ``(now - lag - 1h, now - lag)``."""
    end = now.cast("timestamp_ntz") - _dt_interval(0, lag_hours)
    return spark.range(1).select((end - _dt_interval(0, 1)).alias("window_start"), end.alias("window_end"))


def day_window(spark: SparkSession, now: Column) -> DataFrame:
    """Today's window, which the reference starts at 00:00:59."""
    d = now.cast("date")
    start = F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(0), F.lit(0), F.lit(59))
    end = F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(23), F.lit(59), F.lit(59))
    return spark.range(1).select(start.alias("window_start"), end.alias("window_end"))


def window_bounds_text(windows: DataFrame) -> DataFrame:
    """DAT-6: the window ends as the ``%Y-%m-%dT%H:%M:%S`` strings the API takes."""
    return windows.select("*", iso_format("window_start").alias("from"), iso_format("window_end").alias("to"))


def _hour_of(t: str) -> Column:
    """Hours since the epoch, by the calendar fields (no time zone takes part)."""
    return F.unix_date(F.to_date(t)) * 24 + F.hour(t)


def counts_up_to(times: DataFrame, asked: DataFrame) -> DataFrame:
    """``(t, side, n)`` for each ``asked(t, side)``: how many ``times(t)`` are before ``t`` (``side`` 0)
    or not after it (``side`` 2).

    A sweep in two levels: equal instants are counted in each task first, so a hot one is a row;
    within an hour a running sum meets the instants asked for; the hours before add their sums,
    one row an hour of the calendar, whatever the number of articles."""
    found = times.groupBy("t").agg(F.count(F.lit(1)).alias("n")).select("t", F.lit(1).alias("side"), "n")
    events = found.unionByName(asked.select("t", "side", F.lit(0).cast("long").alias("n"))).withColumn("hour", _hour_of("t"))
    running = F.sum("n").over(Window.partitionBy("hour").orderBy("t", "side").rowsBetween(Window.unboundedPreceding, 0))
    hours = events.groupBy("hour").agg(F.sum("n").alias("in_hour"))
    earlier = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select("hour", F.coalesce(F.sum("in_hour").over(earlier), F.lit(0)).alias("before"))
    inner = events.withColumn("inner", running).filter(F.col("side") != 1)
    return inner.join(hours, "hour").select("t", "side", (F.col("before") + F.col("inner")).alias("n"))


def count_per_window(articles: DataFrame, windows: DataFrame, ts_col: str = "published_ts") -> DataFrame:
    """RA-7: articles per window, both ends inclusive, windows with none kept (count 0).

    A window's count is the difference of two running counts, at its end and before its start, so
    neither overlapping windows nor a hot day make more rows of an article."""
    wins = windows.select("window_start", "window_end")
    times = articles.select(as_col(ts_col).cast("timestamp_ntz").alias("t")).filter(F.col("t").isNotNull())
    end = lambda name, side: F.struct(F.col(name).cast("timestamp_ntz").alias("t"), F.lit(side).alias("side"))
    asked = wins.select(F.inline(F.array(end("window_start", 0), end("window_end", 2)))).filter("t is not null").distinct()
    upto = counts_up_to(times, asked)
    first = upto.filter("side = 0").select(F.col("t").alias("_s"), F.col("n").alias("_before"))
    last = upto.filter("side = 2").select(F.col("t").alias("_e"), F.col("n").alias("_through"))
    both = wins.join(first, F.col("window_start").cast("timestamp_ntz") == F.col("_s"), "left")
    both = both.join(last, F.col("window_end").cast("timestamp_ntz") == F.col("_e"), "left")
    n = F.greatest(F.coalesce(F.col("_through") - F.col("_before"), F.lit(0)), F.lit(0))
    return both.select("window_start", "window_end", n.cast("long").alias("articles"))


def landing_completeness(pages: DataFrame, page_size: int = 100) -> DataFrame:
    """RA-8: per landing window, pages and articles expected from the total that the
    envelopes state against what landed. ``pages`` has one row per landed envelope with
    ``window_start``, ``page``, ``totalResults`` and ``n_articles``; a page delivered again
    counts once, by its fullest delivery. Windows that start at different hours are apart."""
    per_page = pages.groupBy("window_start", "page").agg(
        F.max("totalResults").alias("totalResults"), F.max("n_articles").alias("n_articles")
    )
    per_window = per_page.groupBy("window_start").agg(
        F.max("totalResults").alias("total_results"),
        F.count("page").alias("landed_pages"),
        F.sum("n_articles").cast("long").alias("landed_articles"),
    )
    expected = page_count("total_results", page_size)
    return per_window.select(
        "window_start", "total_results",
        expected.alias("expected_pages"),
        "landed_pages", "landed_articles",
        F.greatest(expected - F.col("landed_pages"), F.lit(0)).alias("missing_pages"),
        ((F.col("landed_pages") >= expected) & (F.col("landed_articles") >= F.col("total_results"))).alias("complete"),
    )
