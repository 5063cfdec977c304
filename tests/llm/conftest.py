import pytest

SF = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor sit amet " * 8000


@pytest.fixture()
def documents(spark):
    """Builds a documents table from (doc_id, text, lang, source) rows, with columns whose
    names clash with those the operators make."""

    def make(rows):
        full = [(*r, len(r[1]) if r[1] is not None else None, "x", 1) for r in rows]
        kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, _h int"
        clash = "shard string, kept string, distance string, n_words string, _doc string, _k1 string, _drop string"
        return spark.createDataFrame([(*r, *(["c"] * 7)) for r in full], f"{kinds}, {clash}")

    return make


@pytest.fixture()
def awkward(documents):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    return documents([
        (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.", "en", "s1"),
        (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.", "en", "s1"),
        (2, None, "en", "s1"), (3, "", None, "s1"), (4, " \t\n", "en", None), (None, "one two three", "en", "s2"),
        (None, None, None, None), (5, LONG, "en", "s2"), (6, "word", "fr", "s2"), (7, "\n\n\n", "fr", "s2"),
    ])


@pytest.fixture()
def nothing(documents):
    return documents([])
