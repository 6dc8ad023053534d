import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
LONG = "word " * 20_000 + "end."


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) pairs or full rows."""
    def make(*rows):
        full = [row if len(row) == 5 else (*row, "en", "src", len(row[1] or "")) for row in rows]
        return spark.createDataFrame(full, DOCUMENTS)
    return make


@pytest.fixture
def awkward(documents):
    """Nulls in every column, empty and very long texts, repeated rows."""
    return documents(
        (None, None, None, None, None), (1, None), (2, ""), (3, " \n\t "), (4, LONG),
        (5, "one two three"), (5, "one two three"), (6, "one two three"), (None, "no id here"))


@pytest.fixture
def clashing():
    """Adds columns named like those that operators make."""
    def add(frame):
        from pyspark.sql import functions as F
        for name in ("f", "key", "kept", "stratum", "fingerprint", "component", "matches", "start",
                     "length", "shard", "n", "_position", "_text", "_words", "tokens", "score"):
            frame = frame.withColumn(name, F.lit("x"))
        return frame
    return add


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
