import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from newsmart.schemas import ARTICLE  # noqa: E402
from newsmart.session import DEFAULT_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[*]").appName("newsmart-tests")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = "8"
    for k, v in conf.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests run locally: the shared checkpoint folder is ours to pick.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="newsmart-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="newsmart-test-", dir="/tmp")


def article(**kw):
    """A landing article row (dict) with defaults; ``source`` is (id, name) or None."""
    base = dict(
        source=("s1", "Source One"), author="Ana", title="Title", description="word words",
        url="https://a.example.com/1", urlToImage=None, publishedAt="2024-03-25T10:00:00Z",
        content="body", language="pt",
    )
    base.update(kw)
    return base


LANDING_ROW = T.StructType(
    ARTICLE.fields
    + [
        T.StructField("load_date", T.DateType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("page", T.IntegerType()),
    ]
)


@pytest.fixture()
def landing_df(spark):
    """Build a landing DataFrame from article dicts (plus load_date/window_start/page)."""
    import datetime as dt

    def make(rows):
        out = []
        for r in rows:
            r = dict(r)
            src = r.pop("source")
            out.append(
                (
                    None if src is None else src,
                    r["author"], r["title"], r["description"], r["url"], r["urlToImage"],
                    r["publishedAt"], r["content"], r["language"],
                    r.get("load_date", dt.date(2024, 3, 26)),
                    r.get("window_start", dt.datetime(2024, 3, 25)),
                    r.get("page", 1),
                )
            )
        return spark.createDataFrame(out, LANDING_ROW)

    return make
