import corpus_pipeline
from newsmart.llm import decontamination, lines, packing, quality, simhash
from newsmart.llm.common import table
from newsmart.llm.queries import QUERIES
from tests.llm.conftest import SF


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"
    ]
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() <= docs.count()


def test_run_matches_the_operators_one_by_one(spark):
    """Each stage by its operator's report, kept rows picked here."""
    docs = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    schema = table(spark, SF, "documents").schema
    frame = lambda: spark.createDataFrame(list(docs.values()), schema)
    good = {r["doc_id"] for r in quality.statistics_and_verdicts(frame()).filter("kept").collect()}
    docs = {k: v for k, v in docs.items() if k in good}
    left = {r["doc_id"]: r["text"] for r in lines.report(frame()).collect()}
    docs = {k: (k, left[k], v["lang"], v["source"], len(left[k])) for k, v in docs.items()}
    one = {r["component_id"] for r in simhash.components(frame()).collect()}
    docs = {k: v for k, v in docs.items() if k in one}
    bench = table(spark, SF, "benchmark")
    clean = {r["doc_id"] for r in decontamination.report(frame(), bench).filter("not contaminated").collect()}
    docs = {k: v for k, v in docs.items() if k in clean}
    want = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packing.pack(frame()).collect())
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want


def test_every_operator_has_its_query():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {k.split("_")[0] + "_" for k in names} and "pipeline" in names
    assert set(QUERIES) <= names and set(e.oracle_sql()) <= names


def test_stages_take_awkward_and_empty_tables(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
