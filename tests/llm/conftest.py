import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tests"))

import pytest  # noqa: E402

SF = os.environ.get("BRANDPULSE_TEST_SF", "/root/testdata/sf0.001")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, blanks, one word, equal texts, a repeated row, a long text, and columns whose names the
    operators use themselves."""
    from pyspark.sql import functions as F
    base = " ".join(f"w{i}" for i in range(80)) + "."
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "one", "en", "b", 3),
            (5, base, "en", "b", len(base)), (6, base, "en", None, len(base)), (7, base + " more.", "de", "a", 9),
            (8, "lone words here.", "en", "a", 16), (8, "lone words here.", "en", "a", 16),
            (9, "été  à la <|endoftext|> plage\r\n" * 3, "fr", "c", 1),
            (10, " ".join(f"v{i % 977}x{i}" for i in range(20_000)) + ".", "en", "c", 7)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("_pid", "_row", "_pos", "k", "size", "spans", "shard", "copies", "kept", "_words", "sequence_id", "_input", "_rid", "_rows"):
        df = df.withColumn(c, F.lit(1))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, -1)
    yield
    spark.conf.set(key, was)
