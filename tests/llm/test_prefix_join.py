import itertools
import re
from pathlib import Path

import numpy as np
import pytest

from viewtide.llm import prefix_join
from viewtide.storage import shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = WORD.findall((text or "").translate(FOLD))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    """All pairs compared; the smallest id of every component."""
    sets = [plain_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc)
                   for i, (doc, _) in enumerate(rows)), key=str)


def found(docs, **options):
    return sorted(map(tuple, prefix_join.link_documents(docs, **options).collect()), key=str)


def changed(words, *places):
    return " ".join(f"other{i}" if i in places else word for i, word in enumerate(words))


def near_copies(n=40, seed=3):
    """Copies of three texts with few and many changes, strangers that share a long
    passage, repeated and short texts."""
    rng = np.random.default_rng(seed)
    bases = [[f"{name}{i}" for i in range(150)] for name in "abc"]
    texts = [changed(base, *rng.choice(150, k, replace=False).tolist())
             for base in bases for k in rng.integers(0, 12, n)]
    passage = " ".join(f"shared{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"own{k}x{i}" for i in range(rng.integers(0, 40)))
              for k in range(30)]
    texts += [texts[0], texts[0].upper(), None, " \n", "", "one two", "One  two", "one two three"]
    return [(int(i), text) for i, text in zip(rng.permutation(len(texts)), texts, strict=True)]


@pytest.mark.parametrize("options", [
    {}, {"crowd": 2, "block": 8}, {"crowd": 1, "block": 5, "hot": 3}, {"crowd": 1000},
    {"crowd": 4, "hot": 1}])
def test_equals_brute_force(documents, options):
    rows = near_copies()
    assert found(documents(*rows), **options) == plain(rows)


def test_groups_of_equal_prefixes(documents):
    """Hundreds of copies with one change, many of which have the same prefix."""
    base = [f"w{i}" for i in range(150)]
    rows = [(1000 - i, changed(base, i % 150, *[j for j in (7, 90) if i % 3 == 0]) + f" t{i % 4}")
            for i in range(240)]
    prefixes = {}
    for _, text in rows:
        s = prefix_join.shingle_set(text)
        key = (len(s), s[:prefix_join.prefix_size(len(s))].tobytes())
        prefixes.setdefault(key, set()).add(s.tobytes())
    assert max(map(len, prefixes.values())) > 3
    for crowd in (2, 100):
        assert found(documents(*rows), crowd=crowd, block=16) == plain(rows)


def test_border_of_the_similarity(documents):
    """Sets of 100 shingles with exactly 80 % and just below."""
    words = [f"w{i}" for i in range(104)]
    # The union of sets with a shared and b, c own shingles is a + b + c.
    rows = [(1, " ".join(words)), (2, " ".join(words[:84])), (3, " ".join(words[:83]))]
    sizes = {i: len(plain_set(text)) for i, text in rows}
    assert (sizes[1], sizes[2], sizes[3]) == (100, 80, 79)
    assert found(documents(rows[0], rows[1])) == [(1, 100, 1), (2, 80, 1)]
    assert found(documents(rows[0], rows[2])) == [(1, 100, 1), (3, 79, 3)]


@pytest.mark.parametrize("percent", [80, 50, 91])
def test_prefixes_suffice(percent):
    """Any two sets of the similarity meet in their prefixes, whatever the order."""
    rng = np.random.default_rng(percent)
    for _ in range(300):
        size = int(rng.integers(1, 60))
        a = rng.choice(80, size, replace=False)
        b = np.unique(np.concatenate([a[:int(rng.integers(0, size + 1))],
                                      rng.choice(80, int(rng.integers(0, 9)), replace=False)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        if not prefix_join.reaches(both, len(a), len(b), percent):
            continue
        small, large = sorted([np.sort(a), np.sort(b)], key=len)
        order = rng.permutation(80)
        small, large = (x[np.argsort(order[x])] for x in (small, large))
        assert set(small[:prefix_join.index_size(len(small), percent)].tolist()) & set(
            large[:prefix_join.prefix_size(len(large), percent)].tolist())


def test_shingles_of_long_and_odd_texts(monkeypatch):
    texts = [" a b\tc\n d  e f ", "x", "A b a B a b a b", "é É ß ẞ a b", "one " * 5000,
             " ".join(f"w{i}" for i in range(20000)), "\x1f \x1c a", "  a b c d e"]
    for size in (1 << 18, 16):
        monkeypatch.setattr(prefix_join, "_SLICE", size)
        for text in texts:
            assert len(prefix_join.shingle_set(text)) == len(plain_set(text))
    one, two = prefix_join.shingle_set(texts[0]), prefix_join.shingle_set("A B C D E F")
    assert one.tolist() == two.tolist()


def test_awkward_rows(awkward, clashing, documents):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(clashing(awkward)) == plain(rows)
    assert found(documents((None, "a b c d e f"), (None, "a b c d e f"))) == [(None, 2, None)] * 2
    assert found(awkward.filter("false")) == []


def test_work_grows_with_the_nodes_of_a_cluster(documents, monkeypatch):
    """Near copies of one text are linked by stars, and a text is shipped to one place."""
    base = [f"w{i}" for i in range(150)]
    rows = [(i, changed(base, i)) for i in range(100)]
    asked, verified = [], prefix_join._verified

    def counted(pairs, *more):
        asked.append(pairs.count())
        return verified(pairs, *more)
    monkeypatch.setattr(prefix_join, "_verified", counted)
    assert found(documents(*rows)) == plain(rows)
    assert sum(asked) <= 2 * len(rows)


def test_candidates_larger_than_a_block(spark, documents, monkeypatch):
    """Pairs meet in the blocks of their nodes; prefixes are deleted when they are used up."""
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("viewtide-*/*"))
    rows = near_copies()
    monkeypatch.setattr(prefix_join, "_BLOCK_SHINGLES", 2000)
    assert found(documents(*rows)) == plain(rows)
    left = {path.name for path in set(folder.glob("viewtide-*/*")) - before}
    assert "rows" in left and not left & {"marks", "prefixes"}
