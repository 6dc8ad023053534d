import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import SF_DIR
from viewtide.llm import ppm
from viewtide.llm.queries import op8_partial_matching

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


class Brute:
    """Partial matching with dictionaries, byte by byte."""

    def __init__(self, order):
        self.order, self.seen = order, [defaultdict(Counter) for _ in range(order + 1)]

    def coded(self, words):
        return [0xFE] * self.order + list(" ".join(words).encode()) + [0xFF]

    def learn(self, words):
        line = self.coded(words)
        for at in range(self.order, len(line)):
            for j in range(self.order + 1):
                self.seen[j][tuple(line[at - j:at])][line[at]] += 1

    def score(self, words):
        line, total = self.coded(words), 0.0
        for at in range(self.order, len(line)):
            out = set()
            for j in range(self.order, -1, -1):
                known = self.seen[j].get(tuple(line[at - j:at]))
                if not known:
                    continue
                left = {s: n for s, n in known.items() if s not in out}
                whole = sum(left.values()) + len(left)
                if line[at] in left:
                    total += math.log10(left[line[at]] / whole)
                    break
                if left:
                    total += math.log10(len(left) / whole)
                out = set(known)
            else:
                total -= math.log10(256 - len(out))
        return total


def check(rows, texts, order):
    counts, model = Counter(), Brute(order)
    for doc_id, text in texts:
        if not held_out(doc_id):
            counts.update([*words_of(text), "\n"])
            model.learn(words_of(text))
    whole, kinds = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text in texts:
        words = [*words_of(text), "\n"]
        base = sum(math.log10((counts[w] + 0.1) / (whole + 0.1 * (kinds + 1))) for w in words)
        expected.append((doc_id, held_out(doc_id), len(words), sum(counts[w] > 0 for w in words),
                         whole, base, model.score(words[:-1])))
    order_of = lambda row: (row[0] is None, row[0], row[2])
    for found, wanted in zip(sorted(map(tuple, rows), key=order_of),
                             sorted(expected, key=order_of), strict=True):
        assert found[:5] == wanted[:5]
        assert found[5:] == pytest.approx(wanted[5:], rel=1e-9)


def test_query_equals_brute_force(spark, table):
    texts = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    check(op8_partial_matching(spark, SF_DIR).collect(), texts, ppm.ORDER)


def test_awkward_rows_and_many_chunks(spark, awkward, documents, clashing):
    texts = [(r["doc_id"], r["text"]) for r in awkward.collect()] + [
        (i, f"Some wörd {i} and\tmore  of it") for i in range(7, 40)]
    docs = awkward.unionByName(documents(*texts[awkward.count():])).coalesce(1)
    rows = ppm.score(clashing(docs), order=3, chunk_bytes=60).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, texts, 3)


def test_no_training_documents_and_no_documents(spark, documents):
    alone = next(i for i in range(100) if held_out(i))
    row = ppm.score(documents((alone, "ab"))).first()
    assert (row["n_known"], row["train_tokens"]) == (0, 0)
    assert row["score"] == pytest.approx(-3 * math.log10(256))
    assert ppm.score(documents((alone, "ab")).filter("false")).count() == 0


def test_packed_numbers_and_parts():
    numbers = np.array([0, 1, -1, 1 << 47, 5, 5, 5], np.int64)
    assert ppm.unpacked(ppm.packed(numbers)).tolist() == numbers.tolist()
    assert ppm.unpacked(ppm.packed(numbers[:0])).tolist() == []
    keys, counts = ppm.counted_grams(["one two three", "two three four"])
    found = ppm.dealt(keys, counts, 5)
    grams, number = (np.concatenate([ppm.unpacked(row[i]) for row in found]) for i in (1, 2))
    assert dict(zip(grams.tolist(), number.tolist())) == dict(zip(keys.tolist(), counts.tolist()))
    assert len(grams) == len(keys) and len({row[0] for row in found}) == len(found) > 1
    contexts = [{gram >> 8 & 0xFFFFFF for gram in ppm.unpacked(row[1]).tolist()} for row in found]
    assert len(set.union(*contexts)) == sum(map(len, contexts))


def test_a_chunk_has_a_packed_row_per_part_and_none_per_gram_or_word(spark, table):
    docs = table("documents").select("doc_id", "text")
    rows = ppm.chunked(docs.coalesce(1), chunk_bytes=1 << 30, parts=7)
    distinct = len(np.unique(ppm.grams([ppm.tokens_of(r["text"]) for r in docs.collect()])[0]))
    found = rows.filter("grams IS NOT NULL").collect()
    assert len(found) == 7 == rows.filter("words IS NOT NULL").count()
    assert sum(len(ppm.unpacked(r["grams"])) for r in found) == distinct
    assert rows.count() == 15 + rows.filter("low IS NOT NULL").count()
