import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from viewtide.llm import decontamination as d
from viewtide.llm.queries import op9_decontamination


def test_query_equals_sliding_every_window(spark, table):
    items = {row["item_id"]: d.words_of(row["text"]) for row in table("benchmark").collect()}
    expected = {}
    for row in table("documents").collect():
        words = d.words_of(row["text"])
        shingles = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        for item, own in items.items():
            if shingles.isdisjoint(tuple(own[i:i + 5]) for i in range(len(own) - 4)):
                continue
            best = max(d.similarity_of(words[at:at + len(own)], own)
                       for at in range(max(1, len(words) - len(own) + 1)))
            if best >= 0.8:
                expected[row["doc_id"], item] = best
    rows = op9_decontamination(spark, SF_DIR).collect()
    assert len(rows) == table("documents").count()
    assert {(r["doc_id"], m["item_id"]): m["similarity"] for r in rows for m in r["matches"]
            } == expected


def test_changed_shifted_and_partial_passages(spark, documents):
    item = [f"w{i}" for i in range(60)]
    text = " ".join(item)
    benchmark = spark.createDataFrame([(1, text), (2, None), (3, "a b c"), (4, ""), (5, text)],
                                      "item_id LONG, text STRING")
    changed = item[:30] + ["other"] + item[31:]
    longer = item[:20] + ["extra"] + item[20:]
    docs = documents(
        (1, "before it " + text.upper().replace(" ", ",  ") + " after"), (2, " ".join(changed)),
        (3, "x " * 50 + " ".join(longer) + " y" * 50), (4, " ".join(item[:30])),
        (5, "a b c"), (6, None), (7, ""), (8, text + " " + text), (None, text))
    rows = {r["doc_id"]: r["matches"] for r in d.benchmark_matches(docs, benchmark).collect()}
    assert {k for k, m in rows.items() if m} == {None, 1, 2, 3, 8}
    assert [m["item_id"] for m in rows[1]] == [1, 5]
    assert rows[1][0]["first_word"] == 2 and rows[1][0]["n_words"] == 60
    assert rows[8][0]["first_word"] == 0 and rows[8][0]["similarity"] == 1.0
    assert 0.8 <= rows[2][0]["similarity"] < 1 and 0.8 <= rows[3][0]["similarity"] < 1
    assert d.benchmark_matches(docs, benchmark, block_bytes=200).filter(
        F.size("matches") > 0).count() == 5
    assert d.drop_contaminated(docs, benchmark).columns == docs.columns


def test_multi_index_misses_nothing_within_the_radius():
    rng = np.random.default_rng(3)
    marks = rng.integers(0, 2 ** 63, 50).astype(np.uint64)
    index = d.HammingIndex(marks, 23)
    for _ in range(200):
        value = int(marks[rng.integers(50)])
        for bit in rng.choice(64, rng.integers(0, 26), replace=False):
            value ^= 1 << int(bit)
        expected = [i for i, m in enumerate(marks.tolist()) if bin(m ^ value).count("1") <= 23]
        assert index.near(value).tolist() == expected


def test_awkward_rows(spark, awkward, clashing, table):
    wide = clashing(awkward)
    kept = d.drop_contaminated(wide, table("benchmark"))
    assert kept.columns == wide.columns and kept.count() == awkward.count()
    nothing = table("benchmark").filter("false")
    assert d.drop_contaminated(wide, nothing).count() == awkward.count()
    assert d.drop_contaminated(wide.filter("false"), table("benchmark")).count() == 0


def test_fingerprints_find_items_without_the_shingle_index(table, monkeypatch):
    """The same matches when every window is asked and shared shingles choose nothing."""
    texts = tuple(row["text"] for row in table("benchmark").collect())
    items = d.Items(texts, d.SHINGLE, d.SIMILARITY, d.RADIUS)
    docs = [row["text"] for row in table("documents").select("text").collect()
            if row["text"] and len(row["text"]) < 6000]
    expected = [items.matches(text) for text in docs]
    assert sum(map(bool, expected)) >= 3

    def refused(*_):
        raise AssertionError("the shingle index was asked")
    monkeypatch.setattr(items, "shared", refused)
    for text, found in zip(docs, expected, strict=True):
        if found or len(text) < 1500:
            assert items.matches(text, every_window=True) == found
