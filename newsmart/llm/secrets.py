"""Secret scan with a linear-chain conditional random field (operator 7).

Three patterns give the base spans. The field adds what they miss: it tags the tokens of
every run between white space as secret begin (B), inside (I) or outside (O) from the
token's shape, its neighbours and features of the whole file, decoded by Viterbi.

By rule only a token of eight or more ASCII characters with a digit or an inner change of
case may begin a secret, or one of any shape (``NAMED_TOKEN``) among the ``NEAR`` tokens behind a
word that names secrets; and only tokens that adjoin without space may continue one. All others
are outside, so a chain falls apart at white space: decoding the runs that hold such a token, with two
tokens of context at each side (within 60 characters) and the distance to the last naming word of the
whole text, gives the path that decoding the whole text would.

The field is trained here, on the spans that the patterns find in a bounded sample: the
``SAMPLE_DOCS`` texts with the smallest hashes among those that name a secret, and as many
of the others. Training is exact (forward-backward sums, Adam); it needs seconds.

Cases: null and empty texts have no spans; a found span that overlaps a base one is left
out; equal rows get equal spans; without a base span in the sample the field adds none; an
empty table gives no rows; other columns are not read."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm.common import slices, store

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Strings of which an assignment holds one, in lower case: a cheap test before the pattern.
NAMED = ("passw", "secret", "token", "apikey", "api_key")

SAMPLE_DOCS = 500
#: Training runs of each kind (with a secret, without) that are used at most.
SAMPLE_RUNS = 4000
RUN = re.compile(r"(?<!\S)\S*?(?:[0-9]|[a-z][A-Z])\S*")
TOKEN = re.compile(r"[\w+/-]+={0,2}|[^\w\s+/-]")
MAY_BEGIN = re.compile(r"(?=.*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_-]{8,}={0,2}")
TRIGGERS = frozenset(
    "password passwd pwd passphrase secret token key apikey api_key access_key secret_key private credential credentials auth "
    "authorization bearer login signature".split()
)
#: Those words, or parts of one between hyphens and underscores.
TRIGGER = re.compile(rf"(?<![^\W_])(?<![+/])(?:{'|'.join(sorted(TRIGGERS))})(?![^\W_])(?![+/])", re.IGNORECASE)
#: So many tokens behind such a word, one of any shape may begin a secret.
NEAR = 5
NAMED_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{6,}={0,2}")
STATES = ("O", "B", "I")
CONTEXT = 2
#: Training uses no longer runs than this many tokens; decoding takes any.
REACH = 96
FORBIDDEN = -1e9


# ---------------------------------------------------------------- base spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), leftmost and non-overlapping within a kind."""
    out = []
    low = text.lower()
    if any(x in low for x in NAMED) or not text.isascii():
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def _values(text: str) -> list[tuple[int, int]]:
    """What is secret in the base spans: the value of an assignment, else the span."""
    low = text.lower()
    found = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if any(x in low for x in NAMED) else []
    return found + [(s, e) for kind, s, e in base_spans(text) if kind != "assign"]


# ---------------------------------------------------------------- runs and features


class Run:
    """Tokens of a run and its context: text, place, whether it adjoins the one before."""

    __slots__ = ("begins", "ends", "features", "inside", "starts")

    def __init__(self, starts, ends, features, begins, inside):
        self.starts, self.ends, self.features, self.begins, self.inside = starts, ends, features, begins, inside


def _entropy(word: str) -> float:
    n = len(word)
    return -sum(c / n * math.log2(c / n) for c in Counter(word).values())


def shape_features(word: str) -> list[str]:
    if not word[0].isalnum() and len(word) == 1:
        return [f"sign:{word}"]
    n = len(word)
    digits, upper, lower = sum(c.isdigit() for c in word), sum(c.isupper() for c in word), sum(c.islower() for c in word)
    kinds = re.sub(r"[^aA0]+", "-", re.sub(r"[0-9]", "0", re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", word))))
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    size = next(k for k in (3, 7, 11, 15, 19, 31, 39, 63, 10**9) if n <= k)
    out = [
        f"size:{size}", f"digits:{round(4 * digits / n)}", f"changes:{min(changes, 12) // 2}",
        f"bits:{min(int(2 * _entropy(word)), 10)}", f"cases:{upper > 0}{lower > 0}{digits > 0}",
    ]
    if n >= 8:
        if re.fullmatch(r"[0-9]+", word):
            out.append("all digits")
        elif re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", word):
            out.append("hexadecimal")
        if re.fullmatch(r"[A-Za-z]+[0-9]{1,4}", word):
            out.append("word and number")
        if re.fullmatch(r"[0-9]+(-[0-9]+)+", word):
            out.append("number groups")
        if re.fullmatch(r"[A-Z0-9]+", word):
            out.append("capitals and digits")
    return out


def file_features(text: str) -> list[str]:
    """Of the whole file: how much like code or settings it is, and whether it names secrets."""
    signs = sum(text.count(c) for c in "={};")
    low = text.lower()
    return [f"file signs:{min(4, int(200 * signs / max(1, len(text))))}", f"file names:{any(x in low for x in NAMED)}"]


def _tokens(text: str, start: int, end: int) -> list[re.Match]:
    return list(TOKEN.finditer(text, start, end))


def triggers(text: str) -> list[tuple[int, int]]:
    """The tokens of a whole text that name secrets, as (start, end)."""
    out: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        start = m.start()
        while start and (text[start - 1].isalnum() or text[start - 1] in "_+/-"):
            start -= 1
        token = TOKEN.match(text, start)
        if token and (not out or token.end() > out[-1][1]):
            out.append(token.span())
    return out


def _run_at(text: str, at: int) -> tuple[int, int]:
    start, end = at, at
    while start and not text[start - 1].isspace():
        start -= 1
    while end < len(text) and not text[end].isspace():
        end += 1
    return start, end


def _begins(words: list[str], named: int) -> tuple[list[bool], list[int]]:
    """Which tokens may begin a secret, and of each the tokens since the last word that names secrets
    (``named``: at the first)."""
    begins, since = [], []
    for word in words:
        since.append(named)
        names = any(x in TRIGGERS for x in re.split(r"[_-]", word.lower().strip("_-=")))
        begins.append(bool(MAY_BEGIN.fullmatch(word) or (named < NEAR and not names and NAMED_TOKEN.fullmatch(word))))
        named = 0 if names else named + 1
    return begins, since


def runs(text: str, of_file: list[str] | None = None) -> Iterator[Run]:
    """Every run that holds a token which may begin a secret; runs with only white space between them
    are one, as the state at the end of one bears on the next."""
    ends = [e for _, e in triggers(text)]
    spans = {m.span() for m in RUN.finditer(text)}
    for end in ends:
        spans.update(_run_at(text, t.start()) for t in islice(TOKEN.finditer(text, end), NEAR))

    def since(at: int) -> int:
        """Tokens from the last naming one to a place, counted as far as it matters."""
        k = bisect_right(ends, at)
        return sum(1 for _ in islice(TOKEN.finditer(text, ends[k - 1], at), NEAR + 1)) if k else 99

    kept: list[list[int]] = []
    for start, end in sorted(spans):
        if any(_begins([t[0] for t in _tokens(text, start, end)], since(start))[0]):
            if kept and not text[kept[-1][1] : start].strip():
                kept[-1][1] = end
            else:
                kept.append([start, end])
    for start, end in kept:
        of_file = file_features(text) if of_file is None else of_file
        before = _tokens(text, max(0, start - 60), start)[-CONTEXT:]
        after = _tokens(text, end, end + 60)[:CONTEXT]
        yield _run(before, _tokens(text, start, end), after, of_file, since(before[0].start() if before else start))


def _run(before, own, after, of_file, named: int = 99) -> Run:
    """``named``: tokens between the last word that names secrets and the first of these."""
    tokens = [*before, *own, *after]
    words = [t[0] for t in tokens]
    shapes = [shape_features(w) for w in words]
    lo, hi = len(before), len(before) + len(own)
    adjoins = [False, *(a.end() == b.start() for a, b in pairwise(tokens))]
    chunk = list(accumulate(0 if x else 1 for x in adjoins))  # of the tokens without white space between
    mail = {c for c, w in zip(chunk, words, strict=True) if w == "@"}
    begins, since = _begins(words, named)
    features = []
    for i, shape in enumerate(shapes):
        f = ["any", *shape, *of_file, f"named:{min(since[i], NEAR)}"]
        f += [f"prev {x}" for x in shapes[i - 1][:2]] if i else ["first"]
        f += [f"next {x}" for x in shapes[i + 1][:2]] if i + 1 < len(shapes) else ["last"]
        if chunk[i] in mail:
            f.append("mail")
        features.append(f)
    within = [lo <= i < hi for i in range(len(tokens))]
    begins = [a and b for a, b in zip(begins, within, strict=True)]
    inside = [a and i > lo and b for i, (a, b) in enumerate(zip(within, adjoins, strict=True))]
    return Run([t.start() for t in tokens], [t.end() for t in tokens], features, begins, inside)


def gold_states(run: Run, values: list[tuple[int, int]]) -> list[int]:
    out, open_value = [], None
    for s, e, begins, inside in zip(run.starts, run.ends, run.begins, run.inside, strict=True):
        value = next((v for v in values if v[0] <= s and e <= v[1]), None)
        if value is None:
            out.append(0)
        elif value == open_value and inside and out[-1]:
            out.append(2)
        else:
            out.append(1 if begins else 0)
        open_value = value
    return out


# ---------------------------------------------------------------- the field


class Field:
    """Weights of a linear chain over O, B, I: per feature and state, and per pair of states.
    I never starts a chain nor follows O."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.index, self.emit, self.move = index, emit, move

    def decode(self, run: Run) -> list[int]:
        """Viterbi: the states of the best path."""
        scores = np.array([
            self.emit[[self.index[x] for x in f if x in self.index]].sum(axis=0) for f in run.features
        ]) + _mask(run)
        best, back = scores[0] + _START, []
        for row in scores[1:]:
            ways = best[:, None] + self.move
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + row
        path = [int(best.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


_START = np.array([0.0, 0.0, FORBIDDEN])


def _mask(run: Run) -> np.ndarray:
    allowed = np.stack([np.ones(len(run.begins), bool), np.array(run.begins, bool), np.array(run.inside, bool)], axis=1)
    return np.where(allowed, 0.0, FORBIDDEN)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(examples: list[tuple[Run, list[int]]], steps: int = 200, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Maximum likelihood with a quadratic penalty, all examples at every step."""
    names = sorted({x for run, _ in examples for f in run.features for x in f})
    index = {x: k for k, x in enumerate(names)}
    n, t = len(examples), max(len(s) for _, s in examples)
    widest = max(len(f) for run, _ in examples for f in run.features)
    ids = np.full((n, t, widest), len(names))
    mask = np.full((n, t, 3), FORBIDDEN)
    mask[:, :, 0] = 0.0  # beyond a chain's end: outside, at no cost
    gold = np.zeros((n, t), np.int64)
    live = np.zeros((n, t))
    for k, (run, states) in enumerate(examples):
        for i, f in enumerate(run.features):
            ids[k, i, : len(f)] = [index[x] for x in f]
        mask[k, : len(states)] = _mask(run)
        gold[k, : len(states)] = states
        live[k, : len(states)] = 1
    emit, move = np.zeros((len(names) + 1, 3)), np.zeros((3, 3))
    fixed = np.zeros((3, 3))
    fixed[0, 2] = FORBIDDEN
    ones = np.eye(3)
    moments = [np.zeros_like(emit), np.zeros_like(move), np.zeros_like(emit), np.zeros_like(move)]
    both = live[:, 1:] * live[:, :-1]
    for step in range(1, steps + 1):
        score = emit[ids].sum(axis=2) * live[:, :, None] + mask
        ways = (move + fixed)[None, None] * both[:, :, None, None]
        ahead = np.zeros((n, t, 3))
        ahead[:, 0] = score[:, 0] + _START
        for i in range(1, t):
            ahead[:, i] = _logsum(ahead[:, i - 1, :, None] + ways[:, i - 1], 1) + score[:, i]
        behind = np.zeros((n, t, 3))
        for i in range(t - 2, -1, -1):
            behind[:, i] = _logsum(ways[:, i] + (score[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
        total = _logsum(ahead[:, -1], 1)
        share = np.exp(ahead + behind - total[:, None, None])
        pairs = np.exp(
            ahead[:, :-1, :, None] + ways + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        miss = (ones[gold] - share) * live[:, :, None]
        grad_emit = np.stack(
            [np.bincount(ids.ravel(), np.repeat(miss[:, :, s].ravel(), widest), len(names) + 1) for s in range(3)], axis=1
        ) / n - decay * emit
        grad_emit[-1] = 0
        seen = np.zeros((3, 3))
        np.add.at(seen, (gold[:, :-1][both > 0], gold[:, 1:][both > 0]), 1)
        grad_move = (seen - (pairs * both[:, :, None, None]).sum(axis=(0, 1))) / n - decay * move
        for k, (weights, grad) in enumerate(((emit, grad_emit), (move, grad_move))):
            moments[k] = 0.9 * moments[k] + 0.1 * grad
            moments[k + 2] = 0.99 * moments[k + 2] + 0.01 * grad * grad
            weights += rate * (moments[k] / (1 - 0.9**step)) / (np.sqrt(moments[k + 2] / (1 - 0.99**step)) + 1e-8)
    return Field(index, emit[:-1], move + fixed)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field | None:
    """A field learned from the base spans of a bounded sample; None if it has no secret."""
    low, named = F.lower("text"), F.col("text").contains("AKIA")
    for x in NAMED:
        named = named | low.contains(x)
    texts = docs.select("text").filter("text is not null")
    marked = texts.select("text", F.xxhash64("text").alias("_h"), named.alias("_named"))
    # First the hashes, then the texts that have them: no task sends more than it must.
    hashes = store(marked.select("_h", "_named").distinct(), "sample")
    chosen = [
        r["_h"] for which in (True, False)
        for r in hashes.filter(F.col("_named") == which).orderBy("_h").limit(sample_docs).collect()
    ]
    rows = marked.filter(F.col("_h").isin(chosen)).groupBy("_h").agg(F.min("text").alias("text")) if chosen else marked.limit(0)
    sample = [r["text"] for r in rows.orderBy("_h").collect()]
    secret, plain = [], []
    for text in sample:
        values = _values(text)
        for run in runs(text):
            states = gold_states(run, values)
            (secret if any(states) else plain).append((run, states))
    short = [x for x in secret + plain if len(x[1]) <= REACH]
    secret, plain = [x for x in short if any(x[1])][:SAMPLE_RUNS], [x for x in short if not any(x[1])][:SAMPLE_RUNS]
    return train(secret + plain) if secret and plain else None


def field_spans(text: str, field: Field | None) -> list[tuple[str, int, int]]:
    out = []
    if field is None:
        return out
    for run in runs(text):
        states = field.decode(run)
        for i, state in enumerate(states):
            if state == 1:
                out.append(["crf", run.starts[i], run.ends[i]])
            elif state == 2:
                out[-1][2] = run.ends[i]
    return [tuple(x) for x in out]


def all_spans(text: str, field: Field | None) -> list[tuple[str, int, int]]:
    """Base spans, and those the field adds beside them, by start and kind."""
    base = base_spans(text)
    added = [x for x in field_spans(text, field) if not any(s < x[2] and x[1] < e for _, s, e in base)]
    return sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0])))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, s, e in spans)


def scan(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    field = docs.sparkSession.sparkContext.broadcast(fit(docs, sample_docs))
    kept = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [all_spans(x.as_py() or "", field.value) for x in batch.column(1)]
            base = [[x for x in spans if x[0] != "crf"] for spans in found]
            count = lambda kind: pa.array([sum(x[0] == kind for x in spans) for spans in base], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), count("assign"), count("access"), count("hex"),
                 pa.array([hashlib.sha256(_joined(x).encode()).hexdigest() for x in base], pa.string()),
                 pa.array([_joined(x) for x in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )
