"""Token counts as delta-maintained rollups (operator 1).

The totals by source, language and tokenizer version are sums of signed rows. A batch of
changes (inserts, deletes, revised counts) looks up what a document counted so far, and
writes its difference only:

* ``ledger/batch=<id>``: per document touched, what it counts from now on (nothing, if
  deleted), the state that later batches subtract;
* ``deltas/batch=<id>``: the batch's signed sums per source, language and version,
  pre-aggregated, so a source with a third of all rows is one row a task;
* ``commits/batch=<id>``: the marker, written last. A batch with a marker is not applied
  again; one without is not read, and is written anew in full. So any batch may be sent
  any number of times, after any failure, and counts once.

Totals are the sum of the committed deltas; ``compact`` folds batches into one, whose marker holds
the ids of all that it stands for, so those count once after it too.

A batch reads of the ledger the documents that it names: a semi join with the batch, which is broadcast
if it is small, comes before anything is shuffled. Batches are applied one at a time by one
writer, as the number of batches committed orders the ledger. Texts are tokenised in runs of 8 MB; one
longer than that is a run of its own.

Rules of a batch: per (doc_id, version) the change with the greatest ``seq`` counts. An insert
of a document that is there and a revision of one that isn't both set its count; a delete of
an unknown one does nothing. Rows of a null doc_id can't be named again: each insert of one
counts for good, other changes to them do nothing. A null text has no token; null sources and
languages are groups; an empty batch commits and changes nothing; columns that the rules do
not name are not read."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.llm.common import slices, store
from newsmart.llm.tokenize import WORD_BPE, ids_as_bytes, tokenizer_path
from newsmart.session import scratch_path

BYTE_BPE = "byte_bpe_50k.tiktoken"
#: The tokenizers whose counts the corpus keeps.
VERSIONS = (BYTE_BPE, WORD_BPE)
KEY = ["doc_id", "version"]
GROUP = ["source", "lang", "version"]
#: The batch that stands for others; ids of batches may not begin so.
FOLDED = "_folded"
SUMS = ["documents", "tokens"]


def version_of(name: str) -> str:
    """A tokenizer's version: its name and the start of its file's digest."""
    with open(tokenizer_path(name), "rb") as f:
        return f"{name.split('.')[0]}-{hashlib.sha256(f.read()).hexdigest()[:8]}"


@cache
def _encoding(name: str):
    import public_tokenizers
    import tiktoken

    with open(tokenizer_path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def counted(docs: DataFrame, name: str = BYTE_BPE) -> DataFrame:
    """``docs`` (its last column ``text``) with ``version`` and ``tokens`` in place of the text."""
    version = version_of(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if name == WORD_BPE:
            ids = ids_as_bytes(name)
            count = lambda text: len(ids(text.as_buffer().to_pybytes())) // 4 if text.is_valid else 0
        else:
            encode = _encoding(name).encode_ordinary
            count = lambda text: len(encode(text.as_py() or ""))
        for batch in slices(batches, -1):
            n = [count(x) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())],
                [*batch.schema.names[:-1], "version", "tokens"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    return docs.mapInArrow(run, f"{kept}, version string, tokens bigint")


class Rollup:
    """A rollup in a shared folder. One batch is applied at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def committed(self) -> list[str]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        found = (x.getPath().getName().partition("batch=")[2] for x in files.listStatus(folder))
        return sorted(x for x in found if x and files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/batch={x}/_SUCCESS")))

    def _read(self, kind: str) -> DataFrame | None:
        batches = self.committed()
        paths = [f"{self.path}/{kind}/batch={b}" for b in batches]
        return self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*paths) if paths else None

    def counted(self, batch: str) -> bool:
        """Whether the batch is committed, by itself or in a fold."""
        done = self.committed()
        if batch in done or FOLDED not in done:
            return batch in done
        return not self.spark.read.parquet(f"{self.path}/commits/batch={FOLDED}").filter(F.col("id") == batch).isEmpty()

    def current(self, named: DataFrame | None = None) -> DataFrame | None:
        """``(doc_id, version, source, lang, tokens, order)``: the newest entry of each document that
        counts (of those in ``named``); ``tokens`` is null where it was deleted."""
        ledger = self._read("ledger")
        if ledger is None:
            return None
        if named is not None:
            ledger = ledger.join(named.select(*KEY), KEY, "left_semi")
        newest = F.row_number().over(W.partitionBy(*KEY).orderBy(F.desc("order")))
        return ledger.filter("doc_id is not null").withColumn("_nth", newest).filter("_nth = 1").select(*KEY, "source", "lang", "tokens", "order")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes(doc_id, version, op, seq, source, lang, tokens)`` as batch ``batch``: true if it
        was applied now, false if it had been. ``op`` is insert, delete or revise."""
        if batch.startswith(FOLDED):
            raise ValueError(f"a batch may not be named {batch!r}")
        if self.counted(batch):
            return False
        # Stored first: rows with and without an id go two ways, and would be counted for each.
        kept = store(changes.select(*KEY, "op", "seq", "source", "lang", F.coalesce("tokens", F.lit(0).cast("bigint")).alias("tokens")), "changes")
        last = F.row_number().over(W.partitionBy(*KEY).orderBy(F.desc("seq"), "op", "source", "lang", "tokens"))
        named = kept.filter("doc_id is not null").withColumn("_nth", last).filter("_nth = 1")
        nameless = kept.filter("doc_id is null and op = 'insert'")
        after = named.drop("_nth").unionByName(nameless).withColumn("tokens", F.when(F.col("op") != "delete", F.col("tokens")))
        after = after.select(*KEY, "source", "lang", "tokens", F.lit(len(self.committed())).alias("order"))
        after.write.mode("overwrite").parquet(f"{self.path}/ledger/batch={batch}")

        stored = self.spark.read.schema(after.schema).parquet(f"{self.path}/ledger/batch={batch}")
        signed = self._signed(stored, self.current(stored))
        signed.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")
        self._commit(batch, self.spark.createDataFrame([(batch,)], "id string"))
        return True

    def _commit(self, batch: str, ids: DataFrame) -> None:
        ids.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")

    @staticmethod
    def _signed(after: DataFrame, before: DataFrame | None) -> DataFrame:
        plus = after.filter("tokens is not null").select(*GROUP, F.lit(1).alias("documents"), "tokens")
        if before is not None:
            was = before.filter("tokens is not null")
            plus = plus.unionByName(was.select(*GROUP, F.lit(-1).alias("documents"), (-F.col("tokens")).alias("tokens")))
        sums = plus.groupBy(*GROUP).agg(*(F.sum(c).cast("bigint").alias(c) for c in SUMS))
        return sums.filter("documents != 0 or tokens != 0").coalesce(1)

    def totals(self) -> DataFrame:
        """``(source, lang, version, documents, tokens)`` of the groups that hold a document."""
        deltas = self._read("deltas")
        if deltas is None:
            return self.spark.createDataFrame([], "source string, lang string, version string, documents bigint, tokens bigint")
        sums = deltas.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in SUMS))
        return sums.filter("documents != 0 or tokens != 0")

    def compact(self, path: str) -> Rollup:
        """A rollup in a new folder that holds the same state and totals as one batch, and knows all the
        batches that it stands for (one short id each)."""
        out = Rollup(self.spark, path)
        ledger = self._read("ledger")
        if ledger is None:
            return out
        live = self.current().filter("tokens is not null").unionByName(
            ledger.filter("doc_id is null").select(*KEY, "source", "lang", "tokens", "order")
        )
        live.withColumn("order", F.lit(0)).write.mode("overwrite").parquet(f"{out.path}/ledger/batch={FOLDED}")
        self.totals().write.mode("overwrite").parquet(f"{out.path}/deltas/batch={FOLDED}")
        out._commit(FOLDED, self._read("commits").select("id").filter(F.col("id") != FOLDED).distinct())
        return out


def inserts(docs: DataFrame, name: str = BYTE_BPE) -> DataFrame:
    """All of ``docs`` as a batch of inserts."""
    return counted(docs.select("doc_id", "source", "lang", "text"), name).withColumns({"op": F.lit("insert"), "seq": F.lit(0)})


def revisions(docs: DataFrame, name: str = BYTE_BPE) -> DataFrame:
    """New counts of the documents that lose lines when each keeps a line's first copy only."""
    lines = F.split("text", "\n")
    fewer = F.array_join(F.array_distinct(lines), "\n")
    changed = docs.filter(F.size(F.array_distinct(lines)) < F.size(lines)).select("doc_id", "source", "lang", fewer.alias("text"))
    return counted(changed, name).withColumns({"op": F.lit("revise"), "seq": F.lit(0)})


def deletions(docs: DataFrame, names: tuple[str, ...] = VERSIONS) -> DataFrame:
    """The documents whose text a smaller doc_id has, as deletes from each tokenizer's counts."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), "text").alias("_h2"))
    first = keyed.groupBy("_h1", "_h2").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    first = store(first, "copies")  # the join is then of two plain shuffles, of which a hot text's can be split
    copies = keyed.join(first, ["_h1", "_h2"]).filter("doc_id > _first")
    return copies.select(
        "doc_id", F.explode(F.array(*(F.lit(version_of(n)) for n in names))).alias("version"), F.lit("delete").alias("op"), F.lit(0).alias("seq"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("bigint").alias("tokens"),
    )


def maintain(docs: DataFrame, names: tuple[str, ...] = VERSIONS, path: str | None = None) -> Rollup:
    """A corpus's life in batches: a load per tokenizer version, line clean-up, removal of copies. A batch
    sent twice counts once, before the batches are folded into one and after."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "rollup")
    rollup = Rollup(spark, path)
    for name in names:
        rollup.apply(f"load-{version_of(name)}", inserts(docs, name))
        rollup.apply(f"clean-{version_of(name)}", revisions(docs, name))
    rollup = rollup.compact(f"{path}-folded")
    rollup.apply(f"load-{version_of(names[0])}", inserts(docs, names[0]))
    rollup.apply("copies", deletions(docs, names))
    return rollup
