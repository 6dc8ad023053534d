import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF_DIR
from viewtide.llm import packing
from viewtide.llm.queries import TOKENIZER, op5_minimum_slack
from viewtide.llm.tokens import Encoder


def best_sum(available, capacity):
    sums = {0}
    for length, count in available.items():
        for _ in range(count):
            sums |= {s + length for s in sums if s + length <= capacity}
    return max(sums)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=8), st.integers(0, 90))
def test_closest_sum_is_the_largest_that_fits(available, capacity):
    counts = packing.closest_sum(available, capacity)
    assert all(counts[length] <= available[length] for length in counts)
    assert sum(x * n for x, n in counts.items()) == best_sum(available, capacity)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 1000), max_size=20))
def test_patterns_use_up_all_pieces(pieces):
    plan = packing.minimum_slack(pieces, 64)
    used = {}
    for pattern in plan:
        assert sum(x * n for x, n in pattern.counts) <= 64
        for length, count in pattern.counts:
            used[length] = used.get(length, 0) + count * pattern.times
    assert used == pieces


def check_packing(rows, ids, window=2048):
    cover, sequences = {}, {}
    for row in rows:
        full = ids[row["doc_id"]]
        assert row["doc_tokens"] == len(full)
        piece = full[row["start"]:row["start"] + row["length"]]
        assert zlib.crc32(piece.tobytes()) == row["ids_crc32"]
        cover.setdefault(row["doc_id"], []).append((row["start"], row["length"]))
        sequences.setdefault(row["sequence_id"], []).append(row)
    for doc_id, full in ids.items():
        at = 0
        for start, length in sorted(cover[doc_id]):
            assert start == at
            at += length
        assert at == len(full)
    assert sorted(sequences) == list(range(len(sequences)))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for row in sorted(pieces, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        size = pieces[0]["padded_size"]
        assert at <= window and at == pieces[0]["sequence_size"]
        assert size == (at if at & (at - 1) == 0 else window)
        padding += size - at
    return padding / sum(map(len, ids.values()))


def test_query_round_trip(spark, table):
    code = Encoder(TOKENIZER)
    ids = {row["doc_id"]: np.append(np.frombuffer(code._plain(row["text"]), code.dtype), 1)
           .astype("<u4") for row in table("documents").collect()}
    assert check_packing(op5_minimum_slack(spark, SF_DIR).collect(), ids) < 0.02


def test_awkward_rows(awkward, clashing):
    rows = packing.pack_documents(clashing(awkward), TOKENIZER, 1, 64).collect()
    whole = [row for row in rows if row["start"] == 0]
    assert len(whole) == awkward.count()
    assert {row["doc_tokens"] for row in whole if row["doc_id"] in (1, 2, 3)} == {1}
    places = {(row["sequence_id"], row["offset"]) for row in rows}
    assert len(places) == len(rows)
    assert packing.pack_documents(awkward.filter("false"), TOKENIZER, 1).count() == 0


@pytest.mark.parametrize("text", [
    "a b", "Word, word. WORD., é É. ", "x\x1cy", "x y", "Σας ΣΑΣ", "don't 12 34's",
    "<|endoftext|> hi <|startoftext|>x", "é ́a", "日本 語", "a​b \u0085 c", "!? ..,"])
def test_words_encode_like_the_whole_text(text):
    code = Encoder(TOKENIZER)
    for _ in range(2):
        assert code.encode([text, None, ""]) == [code._plain(text), b"", b""]


def test_small_memory_gives_the_same_ids(table):
    texts = [row["text"] for row in table("documents").limit(60).collect()]
    code = Encoder(TOKENIZER, remembered=50)
    assert [code.encode([text])[0] for text in texts] == [code._plain(text) for text in texts]
