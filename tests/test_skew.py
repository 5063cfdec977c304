"""Hot keys: one key holding a third of all rows must be cut down before it is
shuffled (partial aggregation / partial window limit), and a hot join key must be
split by AQE. Measured from the executed plan's shuffle metrics."""

from pyspark.sql import functions as F

from newsmart.operators import gold, keywords
from newsmart.operators.bronze import keep_first

N = 30_000
TASKS = 4


def _final_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan


def _nodes(plan):
    out = [plan]
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        out += _nodes(plan.plan())
    it = plan.children().iterator()
    while it.hasNext():
        out += _nodes(it.next())
    return out


def shuffle_records(df) -> int:
    """Rows written by every shuffle of ``df``'s executed plan (run it first)."""
    total = 0
    for node in _nodes(_final_plan(df)):
        metrics = node.metrics()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec" and metrics.contains("shuffleRecordsWritten"):
            total += metrics.get("shuffleRecordsWritten").get().value()
    return total


def _hot(spark, hot_share=3):
    """N rows over TASKS input partitions; every ``hot_share``-th row has the hot key."""
    ids = spark.range(N, numPartitions=TASKS)
    hot = F.col("id") % hot_share == 0
    return ids.select(
        "id",
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("key"),
    )


def test_hot_dedup_key_is_cut_before_the_shuffle(spark):
    rows = _hot(spark).select(
        F.col("key").alias("title"), F.lit("2024-01-01T00:00:00Z").alias("publishedAt"),
        F.col("id").cast("string").alias("url"), F.lit(1).alias("page"),
    )
    out = keep_first(rows, order=("page", "url"))
    got = out.collect()
    unique = N - N // 3 + 1
    assert len(got) == unique
    assert [r["url"] for r in got if r["title"] == "HOT"] == ["0"]  # the first by order
    assert shuffle_records(out) <= unique + TASKS  # the hot third left each task as one row


def test_hot_word_is_pre_aggregated(spark):
    text = _hot(spark).select(F.concat(F.col("key"), F.lit("xx HOTWORD")).alias("description"))
    counts = keywords.word_counts(text)
    got = {r["Palavra"]: r["Quantidade"] for r in counts.collect()}
    assert got["HOTWORD"] == N and got["HOTxx"] == N // 3
    # Every row carries HOTWORD and a third carry HOTxx, yet each is shuffled at most
    # once per task.
    assert shuffle_records(counts) <= (len(got) - 2) + 2 * TASKS


def test_hot_group_is_pre_aggregated(spark):
    silver = _hot(spark).select(F.col("key").alias("author"), F.lit("c").alias("content"))
    counts = gold.count_articles(silver, ["author"])
    got = {r["author"]: r["number_articles"] for r in counts.collect()}
    assert got["HOT"] == N // 3
    assert shuffle_records(counts) <= (len(got) - 1) + TASKS


def test_hot_author_join_is_split_by_aqe(spark):
    silver = _hot(spark).select(
        F.col("key").alias("author"), F.lit("s").alias("source_name"), F.lit("c").alias("content"),
        F.col("id").alias("doc"), F.lit("x" * 200).alias("payload"),
    )
    authors = silver.select("author").distinct().select(F.monotonically_increasing_id().alias("id_authors"), "author")
    sources = spark.createDataFrame([(0, "s")], "source_id long, source_name string")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",  # force the shuffle join path
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = gold.fact_articles(silver, authors, sources)
        assert fact.count() == N
        fact.collect()
        final = _final_plan(fact).toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final  # the hot author's partition was split across tasks
