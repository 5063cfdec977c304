"""Filter interaction audit by forward-backward path counting (operator 11).

What a filter removes depends on what ran before it. All orders of k filters are the paths
through the lattice of the 2^k sets of filters already applied, and every step of every order
is one of its ``k * 2^(k-1)`` edges. So the corpus is counted once, per part and set of failed
filters; each edge's counts follow from those; and any order is read off the edges.

``forward`` counts the orders that reach a state, ``backward`` those that lead from it to the
end, both by one sweep over the states; their product at an edge is the number of orders that
take it. A filter's removals, weighted so and summed over its edges, are its Shapley value
times the number of orders.

Scale: the one pass over the texts leaves a slim row per document (id, part, failed filters,
text hash). Copies are told by a table of the texts that occur more than once, stored, so
that the join with it is of two plain shuffles and a hot text's rows can be split; labels join
by id. Everything after is ``parts * 2^k`` rows at most. The lattice itself is a constant of
the plan: the number of filters is bounded (``MOST``), not the data.

Cases: a null text is empty; a null part is the empty string's; a null doc_id has no smaller
one and is smaller than none, so it fails no copy filter; of rows equal in id and text none is
smaller than the other, so each is as the id is; a document without a label counts as neither
good nor toxic; an id labelled twice has a flag if either label has; an empty table has no
parts, so no rows; other columns are not read."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.llm.common import WORD_SPACE, store

#: Filters by name: SQL over ``text``, ``words`` and ``n_words``, true where a document fails.
FILTERS = {
    "A": "n_words < 200",
    "B": "100 * size(array_distinct(words)) < 50 * n_words",
    "C": "100 * (octet_length(text) - octet_length(regexp_replace(text, '[A-Z]+', ''))) > 2 * char_length(text)",
    "D": "text rlike '[#$%&*|]'",
}
#: The filter that a text fails where a smaller doc_id has the same one.
COPIES = "E"
#: Most filters of one audit: there are k! orders to report.
MOST = 7
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """Per state (a set of applied filters, as bits): how many orders lead from the empty set to
    it, and from it to the full one."""
    full = (1 << k) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(full + 1):
        for f in range(k):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full, -1, -1):
        for f in range(k):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def lattice(k: int) -> list[tuple[int, int, int, int]]:
    """``(edge, state, bit, paths)``: each edge applies the filter ``bit`` to ``state``; ``paths`` of
    the orders take it."""
    forward, backward = path_counts(k)
    steps = [(s, 1 << f) for s in range(1 << k) for f in range(k) if not s >> f & 1]
    return [(e, s, bit, forward[s] * backward[s | bit]) for e, (s, bit) in enumerate(steps)]


def _failed(conditions: dict[str, Column], names: list[str]) -> Column:
    return sum((F.when(conditions[n], 1 << names.index(n)).otherwise(0) for n in conditions), F.lit(0))


def failures(docs: DataFrame, filters: dict[str, str] = FILTERS, copies: str | None = COPIES, part: str = "source") -> DataFrame:
    """``(doc_id, part, mask)`` per row: the filters it fails, as bits in the order of names
    ``[*filters, copies]``. Each is judged on the whole table, whatever the others remove."""
    names = [*filters, *([copies] if copies else [])]
    if len(names) > MOST:
        raise ValueError(f"at most {MOST} filters have all their orders reported")
    rows = docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", WORD_SPACE), lambda w: w != ""))
    rows = rows.withColumn("n_words", F.size("words"))
    mask = _failed({n: F.expr(c) for n, c in filters.items()}, names)
    facts = rows.select(
        "doc_id", "part", mask.alias("mask"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")
    )
    if not copies:
        return facts.select("doc_id", "part", "mask")
    facts = store(facts, "failures")
    several = facts.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    several = store(several.filter("first < last").drop("last"), "copies")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << names.index(copies)).otherwise(0)
    return facts.join(several, ["h1", "h2"], "left").select("doc_id", "part", (F.col("mask") + copy).alias("mask"))


def tally(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by the filters they fail."""
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    flags = labels.filter("doc_id is not null").groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    rows = failed.join(flags.filter("good = 1 or toxic = 1"), "doc_id", "left")
    return rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("good", "toxic"))
    )


def edges(tallied: DataFrame, k: int) -> DataFrame:
    """``(part, edge, bit, paths, ...)``: the counts of every edge of the lattice, zeros included."""
    each = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(("edge", "state", "bit", "paths"), e, strict=True))) for e in lattice(k)))
    rows = tallied.select("part", "mask", "n", "good", "toxic", F.inline(each))
    here = (F.col("mask").bitwiseAND(F.col("state")) == 0)
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    total = lambda when, c="n": F.sum(F.when(when, F.col(c)).otherwise(F.lit(0).cast("bigint")))
    return rows.groupBy("part", "edge", "bit", "paths").agg(
        total(here & ~fails).alias("kept"), total(here & fails).alias("removed"), total(~here & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(here & fails, "good").alias("good_lost"), total(here & fails, "toxic").alias("toxic_lost"),
    )


def orders(of_edges: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step, read from the edges; ``shapley`` is the sum
    over the edges of the step's filter, each weighted by the orders that take it."""
    k = len(names)
    edge_of = {(s, bit): e for e, s, bit, _ in lattice(k)}
    paths = []
    for order in permutations(range(k)):
        state, steps = 0, []
        for f in order:
            steps.append(edge_of[state, 1 << f])
            state |= 1 << f
        paths.append(("".join(names[f] for f in order), steps))
    each = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.array(*map(F.lit, steps)).alias("steps")) for o, steps in paths))
    parts = of_edges.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("edge", "bit", "paths", *COUNTS))).alias("edges"))
    shapley = F.expr(
        "transform(edges, e -> aggregate(edges, 0L, (s, x) -> s + if(x.bit = e.bit, x.paths * x.removed, 0L)))"
    )
    rows = parts.select("part", "edges", shapley.alias("shapley"), F.inline(each))
    rows = rows.select("*", F.posexplode("steps").alias("at", "e"))
    return rows.select(
        "part", "filter_order", (F.col("at") + 1).alias("step"),
        *(F.col("edges")[F.col("e")][c].alias(c) for c in COUNTS), F.col("shapley")[F.col("e")].alias("shapley"),
    )


def audit(
    docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, copies: str | None = COPIES, part: str = "source"
) -> DataFrame:
    """The counts of every order of the filters, per part."""
    names = [*filters, *([copies] if copies else [])]
    counted = edges(tally(failures(docs, filters, copies, part), labels), len(names))
    return orders(counted, names)
