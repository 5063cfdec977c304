"""Quality rules with robust multivariate outliers (operator 4, DataFrame functions only).

Base rules look at one text. The method then compares a document with its group, the
documents of the same language and source that pass the base rules: a transformed vector
of statistics is rejected by its Mahalanobis distance from a minimum covariance
determinant (MCD) estimate of the group.

The MCD is found by concentration steps from deterministic starts: take the rows of the
support, ``(n + P + 1) / 2`` of a group's n (``SUPPORT`` of a small one), that lie nearest to the present centre, and
re-estimate centre and scatter from them, until the group's determinant falls no more. So
any cluster of fewer rows than the rest is left out. Where the ends' limit then finds at
least ``SUPPORT`` of the group clean, the steps go on with that share, which scatters
less; where it does not, the half stays. Every step is a pre-aggregated sum per
group; the support's border comes from an exact histogram of distances in bins of 2 %, so
no group is ranked in one task. A fixed diagonal (``FLOOR``) is added to the scatter, as
in the regularised MCD: most texts have no symbol and no repeat, and a variance of zero
would make every other text an outlier.

Cases: a null text has no words and fails the base rules; null languages and sources are
groups like others; a group of one document accepts it; equal rows count each; an empty
table gives no rows; other columns are kept apart, so their names can't clash."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.llm.common import WORD_SPACE, drop_stored, store

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: Share of a group that the estimate rests on where the half's limit finds so many rows clean.
SUPPORT = 0.75
#: A clean document is rejected once in so many, if its vector is normal.
ONE_IN = 1_000
#: Words that a mean is smoothed with, so that short texts do not scatter more than long ones.
PRIOR_WORDS, PRIOR_CHARS, PRIOR_LINES = 20, 100, 5
#: Standard deviations that are added to the scatter, by component of the vector. The range of
#: each (1 for duplicate lines, 0.44 for the repeats that the base rules leave) is over 4.3 of
#: them, the square root of the limit, so that each can reject alone.
FLOOR = (0.1, 0.1, 0.18, 0.1)
P = len(FLOOR)
#: Bins a unit of ln(distance), and a unit of a component.
DISTANCE_BINS, VALUE_BINS = 50, 100
#: A determinant whose logarithm falls by no more than this stays.
STAYS = 1e-6
_PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def text_statistics(text: str = "text") -> list[tuple[str, str]]:
    """SQL of the statistics in three layers: what a layer makes, the next one uses."""
    words = f"filter(split({text}, '{WORD_SPACE}'), w -> w != '')".replace("\\", "\\\\")
    lines = (
        f"filter(split({text}, '\\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')".replace("\\", "\\\\")
    )
    window = ", ".join(f"_w[i + {k}]" for k in range(5))
    shingles = f"if(size(_w) >= 5, transform(sequence(0, size(_w) - 5), i -> xxhash64({window})), array())"
    # Of the sorted (hash, place) pairs, those beside an equal hash are repeated windows; their
    # places in order cover five words each, less what the one before covers.
    repeats = """
      case when size(array_distinct(_h)) = size(_h) then 0 else
      aggregate(
        array_sort(transform(
          transform(array(array_sort(transform(_h, (h, i) -> struct(h, i)))), s ->
            filter(transform(s, (x, k) -> struct(
              x.i as i, (k > 0 and s[greatest(k - 1, 0)].h = x.h) or (k < size(s) - 1 and s[least(k + 1, size(s) - 1)].h = x.h) as again
            )), x -> x.again))[0], x -> x.i)),
        struct(-5 as last, 0 as n), (a, i) -> struct(i as last, a.n + least(5, i - a.last) as n), a -> a.n)
      end"""
    return [
        ("_w", f"coalesce({words}, cast(array() as array<string>))"),
        ("_l", f"coalesce({lines}, cast(array() as array<string>))"),
        ("n_symbols", f"coalesce(char_length(regexp_replace({text}, '[^#*$%&|<>]+', '')), 0)"),
        ("_h", shingles),
        ("n_words", "size(_w)"),
        ("word_chars", "char_length(array_join(_w, ''))"),
        ("n_lines", "size(_l)"),
        ("n_dup_lines", "size(_l) - size(array_distinct(_l))"),
        ("n_repeat_words", repeats),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` as a struct column ``_doc``, its group ``_g`` and the statistics (long)."""
    sql = dict(text_statistics("_doc.text"))
    layer = docs.select(F.struct(*docs.columns).alias("_doc"))
    layer = layer.selectExpr("_doc", *(f"{sql[c]} as {c}" for c in ("_w", "_l", "n_symbols")))
    layer = layer.selectExpr(
        "_doc", "n_symbols", "_w", f"{sql['_h']} as _h", *(f"{sql[c]} as {c}" for c in ("n_words", "word_chars", "n_lines", "n_dup_lines"))
    )
    group = "xxhash64(isnull(_doc.lang), _doc.lang, isnull(_doc.source), _doc.source) as _g"
    return layer.selectExpr(
        "_doc", group, f"cast({sql['n_repeat_words']} as bigint) as n_repeat_words",
        *(f"cast({c} as bigint) as {c}" for c in STATS if c != "n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def vector() -> list[Column]:
    words = F.col("n_words") + PRIOR_WORDS
    return [
        F.log((F.col("word_chars") + PRIOR_CHARS) / words),
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + PRIOR_LINES)),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _chi2_tail(x: float) -> float:
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(P // 2))


def chi2_quantile(tail: float) -> float:
    """The value that a chi-square of P (even) degrees of freedom exceeds with this probability."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_tail(mid) > tail else (lo, mid)
    return hi


def consistency(share: float) -> float:
    """The factor that makes the scatter of the nearest ``share`` that of all, for normal vectors."""
    q = chi2_quantile(1 - share)
    inner = 1 - _chi2_tail(q) - math.exp(-q / 2) * (q / 2) ** (P // 2) / math.factorial(P // 2)
    return share / inner


def _half_share_factor(share: Column) -> Column:
    """``consistency`` of a column of shares from one half on: the quantile by Newton's steps
    on ``(1 + u) exp(-u) = 1 - share``, which rise to it from the median's ``u``."""
    step = lambda u, _: u + (F.exp(-u) * (1 + u) - (1 - share)) / (u * F.exp(-u))
    u = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(chi2_quantile(0.5) / 2), step)
    inner = F.transform(F.array(u), lambda q: share - F.exp(-q) * q * q / 2)[0]
    return F.when(share < 1, share / inner).otherwise(F.lit(1.0))


def _cholesky(of: dict[tuple[int, int], Column]) -> list[tuple[str, Column]]:
    """Columns of the lower triangle of a factor, in an order where each uses earlier ones."""
    out = []
    for i in range(P):
        for j in range(i + 1):
            rest = of[i, j]
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out.append((f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}")))
    return out


def _estimates(moments: DataFrame, keys: list[str], scale: Column) -> DataFrame:
    """Centre ``m*``, factor ``l**`` and log-determinant of each row of summed moments, the
    scatter times ``scale``."""
    means = moments.select(*keys, *(F.col(f"q{i}{j}") / F.col("n") for i, j in _PAIRS), *((F.col(f"s{i}") / F.col("n")) for i in range(P)))
    means = means.toDF(*keys, *(f"q{i}{j}" for i, j in _PAIRS), *(f"m{i}" for i in range(P)))
    cov = {
        (i, j): scale * F.greatest(F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"), F.lit(0.0)) + FLOOR[i] ** 2 if i == j
        else scale * (F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
        for i, j in _PAIRS
    }
    factored = means
    for name, value in _cholesky(cov):
        factored = factored.withColumn(name, value)
    log_det = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0))
    return factored.select(*keys, *(f"m{i}" for i in range(P)), *(f"l{i}{j}" for i, j in _PAIRS), log_det.alias("log_det"))


def distance() -> Column:
    """Squared Mahalanobis distance of ``x*`` from centre ``m*`` under factor ``l**``, by
    forward substitution."""
    z: list[Column] = []
    for i in range(P):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *(F.sum(f"x{i}").alias(f"s{i}") for i in range(P)),
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS),
    )


def _reached(counts: DataFrame, keys: list[str], rows: Column) -> DataFrame:
    """Per key the lowest ``bin`` up to which so many ``rows`` lie, from counts ``n`` per bin;
    ``total`` is the number of a key's rows."""
    total = F.sum("n").over(W.partitionBy(*keys))
    so_far = F.sum("n").over(W.partitionBy(*keys).orderBy("bin"))
    sums = counts.select(*keys, "bin", total.alias("total"), so_far.alias("so_far"))
    return sums.filter(F.col("so_far") >= rows).groupBy(*keys).agg(F.min("bin").alias("cut"))


def _counts(binned: DataFrame, keys: list[str]) -> DataFrame:
    return binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def _starts(rows: DataFrame) -> DataFrame:
    """First estimates: the classical one, and the medians with the median deviations, which
    half of the rows can't move."""
    spark, half = rows.sparkSession, F.ceil(F.col("total") / 2)
    moments = store(_moments(rows, ["_g"]), "moments")
    classic = _estimates(moments, ["_g"], F.lit(1.0)).withColumn("start", F.lit(0))
    long = rows.select("_g", F.posexplode(F.array(*(F.col(f"x{i}") for i in range(P)))).alias("c", "x"))
    counts = store(_counts(long.select("_g", "c", F.floor(F.col("x") * VALUE_BINS).alias("bin")), ["_g", "c"]), "values")
    middle = _reached(counts, ["_g", "c"], half).withColumnRenamed("cut", "middle")
    away = counts.join(middle, ["_g", "c"]).withColumn("bin", F.abs(F.col("bin") - F.col("middle")))
    away = away.groupBy("_g", "c", "middle", "bin").agg(F.sum("n").alias("n"))
    at = _reached(away, ["_g", "c", "middle"], half)
    one = lambda i, v: F.max(F.when(F.col("c") == i, v))
    spread = F.col("cut") / VALUE_BINS * 1.4826
    median = at.groupBy("_g").agg(
        *(one(i, (F.col("middle") + 0.5) / VALUE_BINS).alias(f"m{i}") for i in range(P)),
        *((F.sqrt(one(i, spread * spread) + FLOOR[i] ** 2) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in _PAIRS),
        F.lit(math.inf).alias("log_det"),
    )
    support = F.least(F.floor((F.col("n") + P + 1) / 2), F.ceil(F.col("n") * SUPPORT))
    sizes = moments.select("_g", "n", support.alias("h"), _half_share_factor(support / F.col("n")).alias("scale"))
    both = classic.unionByName(median.withColumn("start", F.lit(1))).withColumn("log_det", F.lit(math.inf))
    first = store(both.join(sizes, "_g"), "mcd")
    drop_stored(spark, moments, counts)
    return first


def _binned(measured: DataFrame, *columns: str) -> DataFrame:
    """Rows beside their group's estimates, with the ``bin`` of their distance."""
    bin_of = F.floor(F.log(distance() + 1e-9) * DISTANCE_BINS)
    return measured.select("_g", "start", *(f"x{i}" for i in range(P)), *columns, bin_of.alias("bin"))


def _concentrate(rows: DataFrame, first: DataFrame) -> DataFrame:
    """Per group the estimates of least determinant on the way of concentration steps from
    the rows of ``first``, each of them until its own determinant falls no more."""
    spark, keys = rows.sparkSession, ["_g", "start", "n", "h", "scale", "was"]
    moving, made, before = first.withColumnRenamed("log_det", "was"), [], []
    while not moving.isEmpty():
        counts = _counts(_binned(rows.join(moving, "_g"), "h"), ["_g", "start", "h"])
        cut = _reached(counts, ["_g", "start", "h"], F.col("h")).drop("h")
        # Stored with the estimates, one small row a group: the rows meet it as they met those,
        # and a group with many of them is not brought together.
        bounded = store(moving.join(cut, ["_g", "start"]), "mcd")
        inside = _binned(rows.join(bounded, "_g"), "n", "h", "scale", "was", "cut").filter("bin <= cut")
        sums = _moments(inside.withColumnRenamed("n", "_all"), ["_all" if k == "n" else k for k in keys])
        now = store(
            _estimates(sums, ["_g", "start", "_all", "h", "scale", "was"], F.col("scale")).withColumnRenamed("_all", "n"), "mcd"
        )
        before += [bounded, now]
        made.append(now)
        moving = now.filter(F.col("log_det") < F.col("was") - STAYS).drop("was").withColumnRenamed("log_det", "was")
    if not made:
        return first
    best = F.row_number().over(W.partitionBy("_g").orderBy("log_det", "start"))
    steps = functools.reduce(DataFrame.unionByName, made)
    ends = store(steps.withColumn("_nth", best).filter("_nth = 1").drop("_nth", "was"), "estimates")
    drop_stored(spark, first, *before)
    return ends


def robust_estimates(rows: DataFrame) -> DataFrame:
    """``(_g, m*, l**)`` per group of ``rows(_g, x*)``: of the starts' ends, the least determinant."""
    halves = _concentrate(rows, _starts(rows))
    limit = chi2_quantile(1 / ONE_IN)
    near = rows.join(halves, "_g").groupBy("_g").agg(F.sum((distance() <= limit).cast("bigint")).alias("near"))
    joined = store(halves.join(near, "_g"), "halves")
    wide = F.ceil(F.col("n") * SUPPORT)
    clean = joined.filter((F.col("near") >= wide) & (F.col("h") < wide)).drop("near")
    more = clean.withColumn("h", wide).withColumn("scale", F.lit(consistency(SUPPORT))).withColumn("log_det", F.lit(math.inf))
    refined = _concentrate(rows, store(more, "mcd"))
    columns = ["_g", *(f"m{i}" for i in range(P)), *(f"l{i}{j}" for i, j in _PAIRS)]
    rest = joined.join(refined, "_g", "left_anti")
    ends = store(refined.select(columns).unionByName(rest.select(columns)), "estimates")
    drop_stored(rows.sparkSession, halves, joined, refined)
    return ends


def judge(stats: DataFrame) -> DataFrame:
    """A stored table of ``with_statistics`` with ``base_failed``, ``distance`` (null if it
    failed the base rules) and ``kept``."""
    marked = stats.withColumn("base_failed", base_failed())
    for i, x in enumerate(vector()):
        marked = marked.withColumn(f"x{i}", x)
    rows = marked.filter(~F.col("base_failed")).select("_g", *(f"x{i}" for i in range(P)))
    measured = marked.join(robust_estimates(rows), "_g", "left")
    d = F.when(~F.col("base_failed"), distance())
    limit = chi2_quantile(1 / ONE_IN)
    keep = F.coalesce(~F.col("base_failed") & (d <= limit), F.lit(False))
    return measured.select(*stats.columns, "base_failed", d.alias("distance"), keep.alias("kept"))


def statistics_and_verdicts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the statistics, base_failed, distance, kept."""
    kept = docs.select("doc_id", "text", "lang", "source")
    stats = store(with_statistics(kept).select(F.col("_doc.doc_id").alias("doc_id"), "_g", *STATS), "quality")
    return judge(stats).drop("_g")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that the rules keep, with the columns they came with."""
    return judge(store(with_statistics(docs), "quality")).filter("kept").select("_doc.*")
