"""Physical plan shapes that matter at scale."""

import pytest

from newsmart import fixtures as fx
from newsmart.operators import analysis, gold, keywords
from newsmart.plans import load_queries

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    return fx.silver_articles(spark, SF)


def test_no_query_plans_a_cartesian_product(spark):
    for name in ("fact_articles", "keyword_histogram", "keyword_all_daily", "window_counts", "silver_merge_keys"):
        p = plan(load_queries()[name].fn(spark, SF))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_dedup_is_pre_limited_before_its_shuffle(spark):
    p = plan(fx.bronze_articles(spark, SF))
    assert "WindowGroupLimit" in p  # partial limit on the map side cuts hot keys to one row per task


def test_null_safe_dimension_join_is_keyed(silver):
    p = plan(gold.fact_articles(silver, gold.dim_author(silver), gold.dim_source(silver)))
    assert "NestedLoop" not in p and "CartesianProduct" not in p
    assert "HashJoin" in p or "SortMergeJoin" in p


def test_top_k_is_take_ordered(silver):
    assert "TakeOrderedAndProject" in plan(analysis.top_sources(silver, 10))
    assert "TakeOrderedAndProject" in plan(keywords.top_words(keywords.word_counts(silver), 3))


def test_counts_are_partially_aggregated(silver):
    p = plan(keywords.word_counts(silver))
    assert "partial_count" in p
    p = plan(gold.all_gold_counts(silver))
    assert "Expand" in p and "partial_count" in p


def test_scans_are_pruned(spark, silver):
    """Only the columns a query needs reach the parquet scan."""
    import re

    def read_schemas(df):
        return re.findall(r"ReadSchema: (struct<[^>]*>)", plan(df))

    by_year = read_schemas(gold.count_articles(silver, ["year"]))
    assert by_year and all("n_chars" not in r for r in by_year), by_year  # lang and source decide ties
    # What is shuffled for a year count is the keys and the tie's digest, not the texts.
    shuffled = [x for x in plan(analysis.rows_by_year(silver)).splitlines() if "WindowGroupLimit" in x]
    assert shuffled and not any("description" in x or "content" in x for x in shuffled)


def _windows(df):
    """(window expression, partitioned?) for every Window node of the physical plan.
    A window spec lists partition keys before sort orders, so a spec whose first
    argument is a sort order has no partition keys."""
    import re

    out = []
    for line in plan(df).splitlines():
        if "Window [" not in line or "WindowGroupLimit" in line:
            continue
        spec = re.search(r"windowspecdefinition\(([^,]*)", line).group(1)
        out.append((line, not re.search(r" (ASC|DESC)\b", spec)))
    return out


def test_no_single_partition_window_on_data(spark):
    """The only unpartitioned window is the running sum over per-range-partition
    counts (one row per partition); every window over data rows is partitioned."""
    for name in ("dim_author", "dim_source", "fact_articles", "bronze_dedup", "dim_author_stable"):
        wins = _windows(load_queries()[name].fn(spark, SF))
        assert wins, name
        for line, partitioned in wins:
            if not partitioned:
                assert "sum(_n" in line and "_pid" in line, (name, line)
