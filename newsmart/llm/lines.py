"""Line deduplication by a segment-partition edit join (operator 5, DataFrame functions only).

A line is dropped when an equal one, or one within ``max_edits`` edits, comes earlier in
the corpus: by ``doc_id`` (nulls last), then text hash, then line number. All earlier lines
count, dropped or not, so the result does not depend on any order of work. Lines without a word
are left alone; those shorter than ``min_chars`` characters go for an equal one only.

Equal lines meet by a 128-bit hash. For the others, a line is cut into ``max_edits + 1``
segments. Within so many edits at least one segment of the shorter line appears unchanged in
the longer one, at a place that its number and the two lengths bound. Segments are indexed
by (length, number, hash of the substring); a line probes the substrings that those bounds
allow, for its own length and each that is up to ``max_edits`` shorter. Lines that share an
index entry are verified by a banded, bit-parallel edit distance, the band of a column being
one small integer, after two cheap tests that hold for all true matches: counts of letters, and
all but ``max_edits`` of 16 pieces unchanged.

Scale: the most frequent lines, ``HEAVY`` of them, are counted first and enter the index
once, so no entry is hot by repetition. Different lines may share a segment too (a template, a
licence with a name in it). Lines that share more than ``HOT`` of them are told apart by what is
left of them: two lines within the edits that share a segment have rests within the edits, so the
rests are cut and indexed the same way, under the shared entry, and so on for ``LEVELS`` (or until no
entry is shared so). Remainders of entries far above the mean go that way before any shuffle. Entries
with a single line, nearly all, drop out in the one shuffle of the index (16 bytes a row, no text). Text is then fetched for the lines
left, and the verification is a semi join: a line leaves with the first match, pairs are
never listed. Broadcast prefilters hold at most 2^20 hash remainders.

Cases: a null text stays null and has no lines; a text may become empty, its row stays; rows
equal in id and text are one document to this operator, and keep the same lines; an empty
table gives no rows; other columns pass through unread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.llm.common import IDENTITY, identity, store

MAX_EDITS = 2
MIN_CHARS = 20
HEAVY = 10_000
#: Different lines that may share an index entry before it is told apart, and how often that is done.
HOT = 256
LEVELS = 5
#: Pieces of a line that are compared before its edit distance is.
PIECES = 16
#: Letters whose numbers are compared first; those of other scripts are not, which only makes that test weaker.
LETTERS = "etaoinshrdlucmgpfwyb"
#: Remainders of hashes that a prefilter tells apart.
REMAINDERS = 1 << 20
LINE = ["_h1", "_h2"]
WORD = r"[^\x20\x09-\x0D]"


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """``_k1, _k2, _n, _line, _h1, _h2, _at``: every line that counts, with its place: those that hold a
    word, and any of ``min_chars`` characters."""
    lines = docs.select("doc_id", "text", *identity())
    lines = lines.select("doc_id", *IDENTITY, F.posexplode(F.split("text", "\n")).alias("_n", "_line"))
    return lines.filter((F.char_length("_line") >= min_chars) | F.rlike("_line", F.lit(WORD))).select(
        *IDENTITY, "_n", "_line",
        F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(1), "_line").alias("_h2"),
        F.struct(F.isnull("doc_id").alias("none"), "doc_id", *IDENTITY, "_n").alias("_at"),
    )


def probes(max_edits: int) -> list[tuple[int, int, int]]:
    """``(shorter, number, shift)``: a line probes segment ``number`` of lines that are ``shorter``
    characters shorter, ``shift`` characters from where those have it. Edits before the segment
    bound the shift, and so do those behind it; (0, number, 0) are the line's own segments."""
    out = []
    for shorter in range(max_edits + 1):
        for number in range(max_edits + 1):
            before = set(range(-number, number + 1))
            behind = set(range(shorter - (max_edits - number), shorter + (max_edits - number) + 1))
            out += [(shorter, number, shift) for shift in sorted(before & behind)]
    return out


def index_entries(lines: DataFrame, line: str, max_edits: int, own_only: bool = False) -> DataFrame:
    """``lines`` with a row for each index entry: ``_key``, ``_indexed`` where it is the line's own segment
    (with ``own_only`` no others), and ``_rest``, the line without it. Segments are even parts, the longer
    ones last. The probes are a constant that is exploded, and a key is one short formula, which the
    JVM compiles."""
    parts = max_edits + 1
    chosen = [(0, n, 0) for n in range(parts)] if own_only else probes(max_edits)
    each = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(("shorter", "number", "shift"), p, strict=True))) for p in chosen))
    own = lines.withColumn("_length", F.char_length(line))
    rows = own.select("*", F.explode(each).alias("_p")).select(
        *lines.columns, F.col("_p.number").alias("_number"), F.col("_p.shift").alias("_shift"),
        (F.col("_length") - F.col("_p.shorter")).alias("_of"), (F.col("_p.shorter") == 0).alias("_same"),
    )
    longer = F.col("_of") % parts  # so many last parts have one character more
    short = ((F.col("_of") - longer) / parts).cast("int")
    first_longer = F.lit(parts) - longer
    start = short * F.col("_number") + F.greatest(F.lit(0), F.col("_number") - first_longer) + 1
    size = short + F.when(F.col("_number") >= first_longer, 1).otherwise(0)
    at = F.greatest(F.lit(1), start + F.col("_shift"))
    key = F.xxhash64("_of", "_number", F.substring(line, at, size))
    indexed = F.col("_same") & (F.col("_shift") == 0)
    rest = F.concat(F.substring(line, F.lit(1), at - 1), F.substring(line, at + size, F.char_length(line)))
    return rows.select(*lines.columns, key.alias("_key"), indexed.alias("_indexed"), rest.alias("_rest"))


def within_edits(a: str, b: str, max_edits: int) -> str:
    """SQL that is true if strings ``a`` and ``b``, both longer than ``max_edits``, are within so many
    edits. Column by column of ``b``, bit k of a band stands for row j - max_edits + k of ``a``: vp and
    vn are where the cell is one more or one less than the cell above. ``d`` follows the band's last
    row until it reaches the end of ``a``, then that row to the last column."""
    t = max_edits
    mask = (1 << (2 * t + 1)) - 1
    last = 1 << (2 * t)
    same = " + ".join(f"if(get(p.a, j + {k - t}) = p.b[j], {1 << k}, 0)" for k in range(2 * t + 1))
    hp = f"(s.vn | ({mask} & ~(z.d0 | s.vp)))"
    hn = "(z.d0 & s.vp)"
    row = f"shiftright({last}, z.j - (size(p.a) - {t}) + 1)"
    step = f"""
      transform(array(struct((((((x.e & s.vp) + s.vp) ^ s.vp) | x.e | s.vn) & {mask}) as d0, x.j as j)), z -> struct(
        ({hn} | ({mask} & ~(shiftright(z.d0, 1) | {hp}))) as vp,
        (shiftright(z.d0, 1) & {hp}) as vn,
        if(z.j < size(p.a) - {t},
           s.d + if((z.d0 & {last}) = 0, 1, 0),
           s.d + if(({hp} & {row}) != 0, 1, 0) - if(({hn} & {row}) != 0, 1, 0)) as d))[0]"""
    start = (mask >> t) << t
    return f"""(abs(char_length({a}) - char_length({b})) <= {t} and
      transform(array(struct(split({a}, '') as a, split({b}, '') as b)), p ->
        aggregate(
          transform(sequence(0, size(p.b) - 1), j -> struct(({same}) as e, j as j)),
          struct({start} as vp, 0 as vn, {t} as d),
          (s, x) -> {step},
          s -> s.d))[0] <= {t})"""


def pieces_and_windows(line: str, length: str, max_edits: int) -> tuple[Column, Column]:
    """``PIECES`` even pieces of a line, and for each the stretch of a line in which the same piece
    of a line within ``max_edits`` edits would be found, were it unchanged."""
    size, left = F.floor(F.col(length) / PIECES).cast("int"), F.col(length) % PIECES
    pieces, windows = [], []
    for k in range(PIECES):
        start = size * k + F.least(F.lit(k), left) + 1
        own = size + (F.lit(k) < left).cast("int")
        slack = 2 * max_edits + 1  # an edit moves a piece by one, and its cut by one
        low = F.greatest(F.lit(1), start - slack)
        pieces.append(F.substring(line, start, own))
        windows.append(F.substring(line, low, own + start - low + slack))
    return F.array(*pieces), F.array(*windows)


def pieces_agree(pieces: str, windows: str, max_edits: int) -> Column:
    """A necessary condition, and cheap: an edit changes one piece at most, so all but ``max_edits``
    are found unchanged."""
    missing = sum((F.when(F.contains(F.col(windows)[k], F.col(pieces)[k]), 0).otherwise(1) for k in range(PIECES)), F.lit(0))
    return missing <= max_edits


def letter_counts(line: str) -> Column:
    return F.array(*(F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit(c), F.lit(""))) for c in LETTERS))


def letters_agree(one: str, two: str, max_edits: int) -> Column:
    """A necessary condition, and cheaper still: an edit changes two counts by one at most."""
    apart = sum((F.abs(F.col(one)[k] - F.col(two)[k]) for k in range(len(LETTERS))), F.lit(0))
    return apart <= 2 * max_edits


def _shared(entries: DataFrame) -> DataFrame:
    """Of ``(key, line)`` rows, ``line``'s lowest bit telling indexed ones, those whose key another
    line has too and some line indexes. One shuffle: the counts reuse it."""
    dealt = entries.repartition("key")
    of = F.col("line").bitwiseAND(~1)
    several = (
        dealt.groupBy("key")
        .agg(F.min(of).alias("lo"), F.max(of).alias("hi"), F.max(F.col("line").bitwiseAND(1)).alias("indexed"))
        .filter("lo < hi and indexed = 1")
        .select("key")
    )
    return dealt.join(several.hint("shuffle_hash"), "key").distinct()


def _remainder(hash_column: str | Column) -> Column:
    return F.pmod(F.shiftright(hash_column, 1), F.lit(REMAINDERS))


def _entries_of(lines: DataFrame, line: str, max_edits: int) -> DataFrame:
    """``(key, line, rest)`` of ``lines(under, of, ...)``: the entries under what the lines share already,
    ``line`` with the lowest bit telling indexed ones."""
    rows = index_entries(lines.select("under", "of", F.col(line).alias("_text")), "_text", max_edits)
    marked = F.col("of").bitwiseOR(F.col("_indexed").cast("bigint"))
    return rows.select(F.xxhash64("under", "_key").alias("key"), marked.alias("line"), F.col("_rest").alias("rest"))


def _far_above_mean(lines: DataFrame, max_edits: int) -> DataFrame:
    """``(_r)``: remainders of entries that so many lines have that one task should not get them all."""
    own = index_entries(lines.select("under", "of", "_text"), "_text", max_edits, own_only=True)
    counts = store(own.groupBy(_remainder(F.xxhash64("under", "_key")).alias("_r")).agg(F.count("*").alias("n")), "remainders")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") > max(HOT, 20 * total // REMAINDERS, total // 200)).select("_r")


def _told_apart(lines: DataFrame, max_edits: int) -> DataFrame:
    """``(key, of, indexed)``: the index entries that several of ``lines(of, _line)`` share, those of more
    than ``HOT`` lines replaced by entries of the lines' rests under them."""
    lines = lines.select(F.lit(0).cast("bigint").alias("under"), "of", F.col("_line").alias("_text"))
    out = None
    of = F.col("line").bitwiseAND(~1)
    for level in range(LEVELS):
        entries = _entries_of(lines, "_text", max_edits)
        last = level == LEVELS - 1
        skewed = _far_above_mean(lines, max_edits)
        keyed = entries.withColumn("_r", _remainder("key"))
        even = entries if last else keyed.join(F.broadcast(skewed), "_r", "left_anti")
        found = store(_shared(even.select("key", "line")), "entries")
        hot = found.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("key")
        hot = store((hot.limit(0) if last else hot).coalesce(16), "hot")
        part = found.join(hot, "key", "left_anti").select("key", of.alias("of"), (F.col("line").bitwiseAND(1) == 1).alias("indexed"))
        out = part if out is None else out.unionByName(part)
        if last or (hot.isEmpty() and skewed.isEmpty()):
            return out
        again = keyed.join(F.broadcast(skewed), "_r", "left_semi").drop("_r").unionByName(entries.join(hot, "key", "left_semi"))
        lines = store(again.select(F.col("key").alias("under"), of.alias("of"), F.col("rest").alias("_text")).distinct(), "rests")
    return out


def similar_lines(lines: DataFrame, counted: DataFrame, max_edits: int) -> DataFrame:
    """``(_h1, _h2)`` of the lines with an earlier one that differs by 1 to ``max_edits`` edits.
    ``counted(_h1, _h2, _first, _count)``: the lines that occur more than once."""
    heavy = counted.orderBy(F.desc("_count"), *LINE).limit(HEAVY).select(*LINE, "_first")
    once = lines.join(F.broadcast(heavy), LINE, "left").filter("_first is null or _first = _at")
    of = F.col("_h1").bitwiseAND(~1)
    found = _told_apart(once.select(of.alias("of"), "_line"), max_edits)

    wanted = store(found.select("of").distinct(), "wanted")
    rests = wanted.select(_remainder("of").alias("_r")).distinct()
    near = lines.withColumn("of", of).withColumn("_r", _remainder("of"))
    near = near.join(F.broadcast(rests), "_r", "left_semi").join(wanted, "of")
    texts = store(near.groupBy("of", *LINE).agg(F.min("_at").alias("at"), F.first("_line").alias("line")), "texts")

    texts = texts.withColumn("length", F.char_length("line"))
    pieces, windows = pieces_and_windows("line", "length", max_edits)
    rows = found.join(texts.select("*", pieces.alias("pieces"), windows.alias("windows"), letter_counts("line").alias("letters")), "of")
    one = rows.select(*(F.col(c).alias(f"a_{c}") for c in rows.columns))
    two = rows.select(*(F.col(c).alias(f"b_{c}") for c in rows.columns))
    match = (
        (F.col("a_key") == F.col("b_key")) & (F.col("a_at") > F.col("b_at")) & (F.col("a_indexed") | F.col("b_indexed"))
        & letters_agree("a_letters", "b_letters", max_edits) & pieces_agree("a_pieces", "b_windows", max_edits)
        & F.expr(within_edits("a_line", "b_line", max_edits))
    )
    return one.join(two, match, "left_semi").select(*(F.col(f"a_{c}").alias(c) for c in LINE)).distinct()


def dropped_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(_k1, _k2, _drop)``: per document with any, the numbers of its lines to drop."""
    lines = _occurrences(docs, min_chars)
    counted = store(
        lines.groupBy(*LINE).agg(F.min("_at").alias("_first"), F.count("*").alias("_count")).filter("_count > 1"), "counted"
    )
    long = lines.filter(F.char_length("_line") >= min_chars)
    near = similar_lines(long, counted, max_edits) if max_edits else counted.select(*LINE).limit(0)
    marks = counted.select(*LINE, "_first", F.lit(False).alias("_all")).unionByName(
        near.withColumn("_all", F.lit(True)), allowMissingColumns=True
    )
    # Stored, so that the join below is of two plain shuffles, of which a hot line's can be split.
    marks = store(marks.groupBy(*LINE).agg(F.max("_first").alias("_first"), F.max("_all").alias("_all")), "marks")
    places = lines.select(*IDENTITY, "_n", *LINE, "_at").join(marks, LINE).filter("_all or _first != _at")
    return store(places.groupBy(*IDENTITY).agg(F.collect_set("_n").alias("_drop")), "drops")


def _apply(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """``docs`` as a struct ``_doc`` with ``_drop``, null where nothing goes. Documents whose hash
    remainder no dropped line has are not shuffled."""
    keyed = docs.select(F.struct(*docs.columns).alias("_doc"), *identity("doc_id", "text"))
    rests = drops.select(_remainder("_k1").alias("_r")).distinct()
    keyed = keyed.withColumn("_r", _remainder("_k1"))
    clear = keyed.join(F.broadcast(rests), "_r", "left_anti").select("_doc", F.lit(None).cast("array<int>").alias("_drop"))
    rest = keyed.join(F.broadcast(rests), "_r", "left_semi").join(drops, IDENTITY, "left").select("_doc", "_drop")
    return clear.unionByName(rest)


_KEPT = "array_join(filter(split(_doc.text, '\\n'), (l, i) -> not array_contains(_drop, i)), '\\n')"


def deduplicate(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines gone from ``text``, and ``n_chars``, where it is there, counted
    anew. Texts that lose nothing stay as they are, as do all other columns."""
    marked = _apply(docs, dropped_lines(docs, max_edits, min_chars))
    marked = marked.withColumn("_text", F.when(F.col("_drop").isNull(), F.col("_doc.text")).otherwise(F.expr(_KEPT)))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("_drop").isNull(), F.col("_doc.n_chars")).otherwise(F.char_length("_text").cast(kind))
    return marked.select(*(new.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns))


def report(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, text (what is left)."""
    kept = docs.select("doc_id", "text")
    marked = _apply(kept, dropped_lines(kept, max_edits, min_chars))
    return marked.select(
        "_doc.doc_id",
        F.coalesce(F.size(F.split("_doc.text", "\n")), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("_drop").isNull(), F.col("_doc.text")).otherwise(F.expr(_KEPT)).alias("text"),
    )
