import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewtide.llm import toxicity as t
from viewtide.llm.queries import op3_toxicity


def kind(what, negated, reported, addressed):
    return t.KINDS.index((what, negated, reported, addressed))


@pytest.mark.parametrize(("text", "expected"), [
    ("You are an idiot.", {kind(0, 0, 0, 1): 2.0}),
    ("An idiot, they said you.", {kind(0, 0, 0, 1): 2.0}),
    ("He said: what an idiot.", {kind(0, 0, 0, 0): 2.0}),
    ("He said what an idiot!", {kind(0, 0, 1, 0): 2.0}),
    ("Not an idiot. IDIOT", {kind(0, 1, 0, 0): 2.0, kind(0, 0, 0, 0): 2.0}),
    ("not one of the many idiot", {kind(0, 0, 0, 0): 2.0}),
    ("I will kill you, scumbag", {kind(1, 0, 0, 1): 1.0, kind(0, 0, 0, 1): 3.0}),
])
def test_events_depend_on_their_clause(text, expected):
    lexicon = t.Lexicon({"=idiot": 2.0, "^scum": 3.0})
    sums = t.events(text, lexicon)
    assert {i: v for i, v in enumerate(sums) if v} == expected


def test_texts_without_events():
    lexicon = t.Lexicon({"=idiot": 2.0})
    assert all(t.events(text, lexicon) is None for text in (None, "", " \n", "you are not here"))


def test_logistic_weights_match_the_gradient():
    rng = np.random.default_rng(1)
    x = rng.random((300, 3))
    y = (x[:, 0] + 0.3 * rng.standard_normal(300) > 0.6).astype(float)
    bias, weights = t.fit_weights(x, y)
    p = 1 / (1 + np.exp(-(bias + x @ weights)))
    assert np.allclose(x.T @ (p - y) + weights, 0, atol=1e-6)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(
        f"{folder}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(
        f"{folder}/documents.parquet").filter("lang = 'en'").collect()}
    rows = op3_toxicity(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels and r["doc_id"] in texts]
    right = [labels[r["doc_id"]] == r["predicted"] for r in held]
    assert sum(right) / len(right) > 0.95
    assert not any(r["predicted"] for r in held if not labels[r["doc_id"]])


def test_copies_do_not_make_evidence(spark, documents):
    copied = " ".join(f"rare{i}" for i in range(40))
    docs = documents(*[(i, copied) for i in range(100)],
                     *[(i, f"plain text number {i} of some words") for i in range(100, 400)])
    labels = spark.createDataFrame([(i, int(i < 100)) for i in range(400)],
                                   "doc_id LONG, toxic INT")
    assert t.learn_lexicon(t.training_sample(docs, labels)) == {}


def test_awkward_rows(spark, awkward, clashing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (5, None)],
                                   "doc_id LONG, toxic INT")
    model = t.fit(clashing(awkward), labels)
    rows = t.score(clashing(awkward).drop("score"), model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert t.fit(awkward, labels.filter("false")).entries == {}
    assert t.score(awkward.filter("false"), model).count() == 0
    assert awkward.select((t.fold(F.col("doc_id")) == 0).alias("h")).filter("h IS NULL").count() == 0
