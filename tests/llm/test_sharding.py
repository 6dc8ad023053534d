import zlib
from collections import Counter, defaultdict

from tests.llm.conftest import SF_DIR
from viewtide.llm import sharding
from viewtide.llm.queries import op2_label_propagation


def check(rows, texts, shards=8):
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
    assert set(slots) <= set(range(shards))
    sizes = [len(slots[shard]) for shard in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    places = defaultdict(Counter)
    for row in rows:
        places[row["text_crc32"]][row["shard"]] += 1
    return [own for own in places.values() if sum(own.values()) > 1]


def test_query_keeps_groups_together(spark, table):
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    rows = op2_label_propagation(spark, SF_DIR).collect()
    for row in rows:
        data = texts[row["doc_id"]].encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert row["law"] == "rows" and row["grown_shard"] is None
    groups = check(rows, texts)
    assert sum(len(own) > 1 for own in groups) <= 0.1 * len(groups)


def test_a_third_of_all_rows_in_one_group(spark, documents):
    rows = [(i, "the same text") for i in range(400)]
    rows += [(i, f"pair {i // 2}") for i in range(400, 800)]
    rows += [(i, f"alone {i}") for i in range(800, 1200)]
    groups = check(sharding.shard_documents(documents(*rows)).collect(), rows)
    large = [own for own in groups if sum(own.values()) == 400]
    assert len(large) == 1 and len(large[0]) <= 5
    assert sum(len(own) > 1 for own in groups) <= 10


def test_awkward_rows(awkward, clashing):
    rows = sharding.shard_documents(clashing(awkward)).collect()
    check(rows, list(range(awkward.count())))
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert sharding.shard_documents(awkward.filter("false")).count() == 0
