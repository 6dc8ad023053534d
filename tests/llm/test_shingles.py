import itertools

import numpy as np
import pytest

import corpus_pipeline
from viewtide.llm import prefix_join, shingles

WORDS = [f"w{i}" for i in range(400)]


def changed(words, *places):
    return " ".join("other" + str(i) if i in places else w for i, w in enumerate(words))


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows, similarity=0.8):
    """Smallest ids of the components of all pairs that reach the similarity."""
    sets = {i: plain_set(text) for i, text in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        union = len(sets[a] | sets[b])
        if not union or len(sets[a] & sets[b]) >= similarity * union:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return sorted(i for i in parent if root(i) == i)


def groups(n=40, seed=3):
    """Near copies with one to nine changed words, beside strangers and null texts."""
    rng = np.random.default_rng(seed)
    bases = [[f"{name}{i}" for i in range(150)] for name in "abc"]
    texts = [changed(base, *rng.choice(150, k, replace=False).tolist())
             for base in bases for k in rng.integers(0, 10, n)]
    return list(enumerate([*texts, None, " \n", "", "one two", "One  two", "one two three"]))


def test_stage_links_by_shingle_similarity(spark, documents):
    """0.95 to 0.81 are linked, 0.78 is not, whatever the fingerprints."""
    texts = [" ".join(WORDS), changed(WORDS, 50), changed(WORDS, 10, 60, 110, 160, 210, 260, 310, 360),
             changed(WORDS, *range(5, 395, 40))]
    rows = [(10 * g + i, " ".join(f"{g}{w}" for w in text.split()))
            for g in range(1, 9) for i, text in enumerate(texts)]
    kept = corpus_pipeline.near_duplicates(spark, documents(*rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == plain_kept(rows)
    assert plain_kept(rows) == sorted(10 * g + i for g in range(1, 9) for i in (0, 3))


@pytest.mark.parametrize(("crowd", "block"), [(16, 256), (2, 8), (1000, 256)])
def test_crowds_equal_brute_force(documents, crowd, block):
    rows = groups()
    kept = shingles.drop_near_duplicates(documents(*rows), 5, crowd=crowd, block=block)
    assert sorted(r["doc_id"] for r in kept.collect()) == plain_kept(rows)


def test_forest_connects_what_all_pairs_connect():
    sets = [np.arange(i, i + 40) for i in range(0, 60, 3)] + [np.arange(500, 540)]
    nodes = list(range(len(sets)))
    found = shingles.forest([*nodes, *nodes], [*nodes, *nodes], [*sets, *sets],
                            [False] * len(sets) + [True] * len(sets), 0.8)
    assert len(found) == 19 and {n for link in found for n in link} == set(range(20))
    known = [0] * 20 + [20]
    assert not shingles.forest([*nodes, *nodes], known + known, [*sets, *sets],
                               [False] * len(sets) + [True] * len(sets), 0.8)


def test_awkward_rows(awkward, clashing):
    wide = clashing(awkward)
    kept = shingles.drop_near_duplicates(wide, 5)
    assert kept.columns == wide.columns
    assert sorted((row["doc_id"] or -1) for row in kept.collect()) == [-1, 1, 4, 5]
    assert shingles.drop_near_duplicates(awkward.filter("false"), 5).count() == 0


def test_pair_that_no_band_of_minhashes_proposes(documents):
    """Nine shingles each, eight in common: exactly 0.8. The 32 bands missed this pair."""
    words = [f"{letter}n740765" for letter in "abcdefghijklm"]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "end"])), (3, "another text")]
    assert plain_kept(rows) == [1, 3]
    kept = shingles.drop_near_duplicates(documents(*rows), 5)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_only_whole_hundredths_are_a_similarity(documents):
    with pytest.raises(ValueError, match="hundredths"):
        shingles.drop_near_duplicates(documents((1, "a")), 5, similarity=0.805)


def test_kept_rows_are_the_least_of_every_component(documents):
    """What stays is what the components of all rows ask for, with ids that repeat or are missing."""
    rows = groups(12) + [(3, "one two"), (None, "w0 w1 w2 w3 w4 w5"), (None, "w0 w1 w2 w3 w4 w5")]
    docs = documents(*rows)
    linked = prefix_join.link_documents(docs).collect()
    worded = {r["component_id"] for r in linked if r["n_shingles"]}
    wordless = min(r["doc_id"] for r in linked if not r["n_shingles"])
    kept = [r["doc_id"] for r in shingles.drop_near_duplicates(docs, 5).collect()]
    assert sorted(kept, key=str) == sorted([*worded, wordless], key=str)
