import re
from collections import Counter
from math import floor, log

import pytest

from viewtide.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, depth=50):
    """The ranking written down term by term."""
    counts = [(i, Counter(TERM.findall((text or "").translate(FOLD)))) for i, text in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_all = sum(sum(c.values()) for _, c in counts)
    rows = []
    for item in {i for i, _ in items}:
        terms = {t for i, text in items if i == item for t in TERM.findall((text or "").translate(FOLD))}
        df = {t: sum(t in c for _, c in counts) for t in terms}
        scores = []
        for i, c in counts:
            n = sum(c.values())
            if not n:
                continue
            m = 100 - 50 + (50 * n * n_docs) // n_all
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        rows += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(
            scores, key=lambda x: x[:3])[:depth], 1)]
    return sorted(rows, key=str)


def ranked(docs, items, **options):
    return sorted(map(tuple, lexical.rank_documents(docs, items, **options).collect()), key=str)


@pytest.fixture
def items(spark):
    return lambda *rows: spark.createDataFrame(rows, "item_id LONG, text STRING")


WORDS = "der the Über naïve x1 42 日本 a_b a.b Ünder ab abc".split()


def corpus(n):
    return [(i, " ".join(WORDS[(i * k + k * k) % len(WORDS)] + ",;- _\n"[k % 6]
                         for k in range(i % 23))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"depth": 3}, {"block_bytes": 16}])
def test_equals_brute_force(documents, items, options):
    docs = corpus(90)
    asked = [(1, "The über NAÏVE"), (2, "a b ab abc"), (3, "日本 x1 42 the the"), (4, "none here"),
             (5, None), (6, "... _"), (7, "der Ünder")]
    depth = options.get("depth", 50)
    found = ranked(documents(*docs).repartition(5), items(*asked), **options)
    assert found == plain(docs, asked, depth)
    assert {row[0] for row in found} == {1, 2, 3, 7}


def test_ties_and_repeated_rows(documents, items):
    docs = [(i, "same text here") for i in (9, 3, 7, 3, None)] + [(1, "other words")] * 4
    found = [tuple(r) for r in lexical.rank_documents(
        documents(*docs), items((0, "same")), depth=4).orderBy("rank").collect()]
    assert [r[:3] for r in found] == [(0, 1, 3), (0, 2, 3), (0, 3, 7), (0, 4, 9)]
    assert len({r[3] for r in found}) == 1
    all_rows = lexical.rank_documents(documents(*docs), items((0, "same"))).orderBy("rank").collect()
    assert [r.doc_id for r in all_rows] == [3, 3, 7, 9, None]


def test_terms_are_whole(spark):
    terms = ("a", "ab", "b", "ü")
    assert lexical.scan("a ab abc A-b ü", terms) == (6, {0: 2, 1: 1, 2: 1, 3: 1})
    assert lexical.scan("", terms) == lexical.scan(None, terms) == (0, {})
    assert lexical.scan("a\x00b\x7fab", terms) == (3, {0: 1, 1: 1, 2: 1})


def test_lengths_beyond_64_bits():
    import numpy as np
    n = np.array([1, 10 ** 9], np.int64)
    assert lexical.lengths(n, 10 ** 10, 10 ** 12).tolist() == [
        50 + 50 * 10 ** 10 // 10 ** 12, 50 + 50 * 10 ** 19 // 10 ** 12]


def test_awkward_rows(awkward, clashing, items, documents):
    asked = items((1, "word one"), (1, "three"), (None, "end id"), (2, None), (2, ""))
    found = ranked(clashing(awkward), asked)
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found == plain(rows, [(1, "word one three"), (None, "end id")])
    assert ranked(documents((1, "x")).filter("false"), asked) == []
    assert ranked(documents((1, "x")), items((1, "x")).filter("false")) == []
    assert ranked(documents((1, None), (2, " ")), asked) == []
