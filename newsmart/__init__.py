"""newsmart: a PySpark-native medallion engine for news-article data.

Landing JSON pages -> bronze (deduplicated articles) -> silver (cleaned, flattened)
-> gold (publication counts, author/source dimensions, article fact), plus keyword
statistics, ranked counts, table profiles, article search, batch-window reports and
incremental loading with Structured Streaming.

Every operator is a function from DataFrame(s) to a DataFrame; writes live in
``newsmart.plans`` and ``newsmart.sources.writers``.
"""

__version__ = "0.1.0"
