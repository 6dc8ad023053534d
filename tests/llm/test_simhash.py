import re

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import SF_DIR
from viewtide.llm import simhash
from viewtide.llm.graph import components
from viewtide.llm.queries import op7_simhash


def plain_fingerprint(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+",
                       re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    pieces = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(piece.encode(), seed=42) for piece in pieces]
    return sum(1 << bit for bit in range(64)
               if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def plain_components(values, radius):
    """Smallest value that each value reaches, by comparing all pairs."""
    parent = {value: value for value in values}

    def root(value):
        while parent[value] != value:
            value = parent[value]
        return value
    for a in values:
        for b in values:
            if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= radius:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {value: root(value) for value in values}


@pytest.mark.parametrize("text", [None, "", "  \n", "One", "a b c", "a b c d", "x " * 70_000,
                                  "Ünïcode wörds ÀB and MORE words here", "a b c\x1cd e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == signed(plain_fingerprint(text))


def test_one_segment_differs_by_one_bit_at_most():
    assert [s.width for s in simhash.segments(4)] == [21, 22, 21]
    assert sum(s.width for s in simhash.segments(7)) == 64 and len(simhash.segments(7)) == 4


def near_values(seed=7):
    """Chains, dense balls and far values."""
    rng = np.random.default_rng(seed)
    values = [int(v) for v in rng.integers(0, 2 ** 63, 60)]
    for center in values[:6]:
        for _ in range(40):
            value = center
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                value ^= 1 << int(bit)
            values.append(value)
    return sorted({signed(v) for v in values})


@pytest.mark.parametrize(("crowd", "block"), [(64, 512), (2, 8)])
def test_links_connect_all_pairs_within_the_radius(spark, crowd, block):
    values = near_values()
    marks = spark.createDataFrame([(v,) for v in values], "f LONG")
    found = {row["node"]: row["component"] for row in components(
        simhash.links(marks, crowd=crowd, block=block)).collect()}
    expected = plain_components(values, 4)
    assert {v: found.get(v, v) for v in values} == expected


def test_components_of_a_chain_a_star_and_repeated_links(spark):
    edges = ([(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
             + [(7, 7), (1, 0), (300, 200)])
    found = dict(components(spark.createDataFrame(edges, "a LONG, b LONG")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)},
                     200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_query_equals_brute_force(spark, table):
    texts = {row["doc_id"]: row["text"] for row in table("documents").collect()}
    marks = {doc_id: signed(plain_fingerprint(text)) for doc_id, text in texts.items()}
    reached = plain_components(sorted(set(marks.values())), 4)
    smallest = {}
    for doc_id, mark in marks.items():
        smallest[reached[mark]] = min(doc_id, smallest.get(reached[mark], doc_id))
    found = {row["doc_id"]: (row["fingerprint"], row["component_id"])
             for row in op7_simhash(spark, SF_DIR).collect()}
    assert found == {doc_id: (f"{mark & (2 ** 64 - 1):016x}", smallest[reached[mark]])
                     for doc_id, mark in marks.items()}


def test_awkward_rows(awkward, clashing):
    rows = simhash.near_duplicates(clashing(awkward)).collect()
    assert len(rows) == awkward.count()
    wordless = [row for row in rows if row["doc_id"] in (1, 2, 3)]
    assert all(row["fingerprint"] == 0 and row["component_id"] == 1 for row in wordless)
    assert {row["component_id"] for row in rows if row["doc_id"] in (5, 6)} == {5}
    assert simhash.near_duplicates(awkward.filter("false")).count() == 0


def test_one_row_of_a_group_stays(awkward, clashing):
    wide = clashing(awkward)
    kept = simhash.drop_near_duplicates(wide)
    assert kept.columns == wide.columns
    assert sorted((row["doc_id"] or -1) for row in kept.collect()) == [-1, 1, 4, 5]


def test_exploded_index_is_never_broadcast(spark, set_conf):
    """Spark takes the index of 64 rows a fingerprint for one of a row each."""
    set_conf("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    marks = spark.createDataFrame([(i,) for i in range(50)], "f LONG")
    plan = simhash.links(marks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2
    assert not re.search(r"BroadcastHashJoin .*\bInner\b", plan)
