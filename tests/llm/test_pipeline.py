import re

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.conftest import SF_DIR
from tests.llm.test_quality import counts
from tests.llm.test_shingles import plain_kept
from viewtide.llm import decontamination
from viewtide.llm.queries import QUERIES


def test_all_queries_are_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


def test_stages_equal_brute_force(spark, table):
    """Each stage against a plain version on what its predecessor kept."""
    docs = table("documents")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)

    kept = stage["quality_rules"](spark, docs, SF_DIR)
    assert kept.columns == columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"]: r["text"] for r in kept.collect()}
    # With so few labels no threshold can be certified: the base rules decide.
    assert good == {i: text for i, text in texts.items() if not counts(text)[5]}

    unique = stage["near_duplicates"](spark, kept, SF_DIR)
    assert unique.columns == columns
    left = {r["doc_id"]: r["text"] for r in unique.collect()}
    assert left == {i: good[i] for i in plain_kept(good.items())}

    clean = stage["benchmark_decontamination"](spark, unique, SF_DIR)
    assert clean.columns == columns
    items = [decontamination.words_of(r["text"]) for r in table("benchmark").collect()]

    def leaks(text):
        words = decontamination.words_of(text)
        return any(decontamination.similarity_of(words[at:at + len(item)], item) >= 0.8
                   for item in items if set(item[:40]) & set(words)
                   for at in range(max(1, len(words) - len(item) + 1))
                   if words[at:at + 8] == item[:8] or at == 0)
    remaining = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert remaining == {i: text for i, text in left.items() if not leaks(text)}

    masked = stage["pseudonyms"](spark, clean, SF_DIR)
    assert masked.columns == columns and masked.schema == docs.schema
    changed = {r["doc_id"]: r for r in masked.collect()}
    assert set(changed) == set(remaining)
    for i, row in changed.items():
        assert len(row["text"]) == row["n_chars"]
        if not re.search(r"[0-9@]", remaining[i]):
            assert row["text"] == remaining[i]

    pieces = stage["packing"](spark, masked, SF_DIR).collect()
    assert {r["doc_id"] for r in pieces} == set(remaining)


def test_run_equals_the_stages_and_empty_tables_pass(spark, table, tmp_path):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0
    for name in ("documents", "labels", "benchmark"):
        table(name).filter("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
