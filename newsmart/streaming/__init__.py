"""Structured Streaming: incremental bronze, streaming dedup, windowed counts."""

from newsmart.streaming.completeness import completeness_stream  # noqa: F401
from newsmart.streaming.incremental import (  # noqa: F401
    append_new_articles,
    compact_bronze_day,
    first_deliveries,
    fold_article_batches,
    landing_stream,
    read_incremental_bronze,
    run_incremental_bronze,
    run_to_parquet,
    start_incremental_bronze,
    windowed_counts,
)
from newsmart.streaming.reconciled import read_reconciled_counts, run_reconciled_counts  # noqa: F401
