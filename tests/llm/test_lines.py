import random

from pyspark.sql import functions as F

from newsmart.llm import lines as L
from newsmart.llm.queries import op5_line_dedup
from tests.llm.conftest import SF


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def slow_dedup(docs, max_edits, min_chars):
    """(doc_id, text) in corpus order -> texts left."""
    seen, out = set(), []
    for doc_id, text in docs:
        left = []
        for line in text.split("\n"):
            near = (x for x in seen if min(len(x), len(line)) >= min_chars and abs(len(x) - len(line)) <= max_edits)
            if not (line in seen or any(edits(x, line) <= max_edits for x in near)):
                left.append(line)
            if line.strip(" \t\n\v\f\r"):
                seen.add(line)
        out.append((doc_id, "\n".join(left)))
    return out


def mutated(line, n):
    line = list(line)
    for _ in range(n):
        at = random.randrange(len(line))
        kind = random.randrange(3)
        if kind == 0:
            line[at] = random.choice("abcé")
        elif kind == 1:
            line.insert(at, random.choice("abcé"))
        elif len(line) > 1:
            del line[at]
    return "".join(line)


def test_bit_parallel_distance_and_index(spark):
    random.seed(3)
    rows = [("".join(random.choice("abcé") for _ in range(random.randint(8, 30))),) for _ in range(400)]
    rows = [(a, mutated(a, random.randint(0, 4))) for (a,) in rows]
    frame = spark.createDataFrame(rows, "a string, b string")
    for t in (1, 2, 3):
        numbered = frame.withColumn("i", F.monotonically_increasing_id())
        keys = {}
        for side in ("a", "b"):
            for e in L.index_entries(numbered.select("i", side), side, t).collect():
                keys.setdefault((e["i"], side, e["_indexed"]), set()).add(e["_key"])
        for r in numbered.select("*", F.expr(L.within_edits("a", "b", t)).alias("near")).collect():
            assert r["near"] == (edits(r["a"], r["b"]) <= t)
            if r["near"]:
                own = {s: keys.get((r["i"], s, True), set()) for s in "ab"}
                every = {s: own[s] | keys.get((r["i"], s, False), set()) for s in "ab"}
                assert own["a"] & every["b"] or own["b"] & every["a"]


def test_matches_brute_force(spark, documents):
    random.seed(6)
    base = ["".join(random.choice("abcd ") for _ in range(random.randint(18, 60))) for _ in range(60)]
    rows = []
    for i in range(80):
        own = [mutated(random.choice(base), random.choice((0, 0, 1, 2, 3))) for _ in range(random.randint(1, 6))]
        rows.append((i, "\n".join([*own, "short"]), "en", "s"))
    for t in (0, 1, 2):
        got = {r["doc_id"]: r["text"] for r in L.report(documents(rows), t, 20).collect()}
        assert got == dict(slow_dedup([(r[0], r[1]) for r in rows], t, 20))


def test_heavy_lines_are_not_lost(spark, documents, monkeypatch):
    monkeypatch.setattr(L, "HEAVY", 1)
    line = "a line that very many documents have in common"
    rows = [(i, line, "en", "s") for i in range(50)] + [(60, line.replace("very", "vary"), "en", "s"), (61, "another line, on its own here", "en", "s")]
    got = {r["doc_id"]: r["text"] for r in L.report(documents(rows)).collect()}
    assert got == {0: line, 61: rows[-1][1]} | {i: "" for i in (*range(1, 50), 60)}


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60)
    want = dict(slow_dedup([(r["doc_id"], r["text"]) for r in docs.collect()], L.MAX_EDITS, L.MIN_CHARS))
    assert {r["doc_id"]: r["text"] for r in L.report(docs).collect()} == want
    whole = op5_line_dedup(spark, SF)
    assert whole.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_awkward_rows(awkward, nothing):
    rows = L.report(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r["text"] for r in rows if r["doc_id"] == 1} == {"Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu."}
    assert [r["text"] for r in rows if r["doc_id"] in (2, 3)] in ([None, ""], ["", None])
    out = L.deduplicate(awkward)
    assert out.columns == awkward.columns and out.dtypes == awkward.dtypes and out.count() == awkward.count()
    assert L.report(nothing).count() == 0 and L.deduplicate(nothing).count() == 0


def templated(n, seed=1):
    """Lines of one template: most differ in many letters, some in one or two."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        if i % 10 == 9:
            out.append(mutated(out[r.randrange(len(out))], r.randint(1, 2)))
        else:
            out.append("Copyright notice of the site " + "".join(r.choice("abcdefghij") for _ in range(r.choice([14, 15, 45]))))
    return out


def test_lines_of_one_template_match_brute_force(spark, documents, monkeypatch):
    """A segment that all share is told apart by the rests; with and without the guard before the shuffle."""
    random.seed(2)
    texts = templated(400)
    docs = documents([(i, t, "en", "s") for i, t in enumerate(texts)])
    want = dict(slow_dedup(list(enumerate(texts)), 2, 20))
    monkeypatch.setattr(L, "HOT", 8)
    for guard in (1 << 20, 1):  # by remainders only where they are far above the mean; or never
        monkeypatch.setattr(L, "REMAINDERS", guard)
        got = {r["doc_id"]: r["text"] for r in L.report(docs).collect()}
        assert got == want


def test_many_templated_lines_make_few_pairs(spark, monkeypatch):
    """The pairs that meet grow with the lines, not with their square."""
    lines = spark.createDataFrame([(i << 1, t) for i, t in enumerate(dict.fromkeys(templated(3000)))], "of bigint, _line string")
    monkeypatch.setattr(L, "HOT", 64)
    found = L._told_apart(lines, 2)
    worst = found.groupBy("key").count().agg(F.max("count"), F.sum(F.col("count") * F.col("count"))).first()
    assert worst[0] <= 300 and worst[1] < 40 * 3000
