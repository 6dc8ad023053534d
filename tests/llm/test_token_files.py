import zlib

import numpy as np
import pytest

from tests.llm.conftest import SF_DIR
from viewtide.llm import token_files
from viewtide.llm.queries import TOKENIZER, op6_token_files
from viewtide.llm.tokens import Encoder
from viewtide.storage import scratch_path


def test_query_round_trip(spark, table):
    code = Encoder(TOKENIZER)
    rows = {row["doc_id"]: row for row in op6_token_files(spark, SF_DIR).collect()}
    start = 0
    for row in sorted(table("documents").collect(), key=lambda r: r["doc_id"]):
        ids = np.append(np.frombuffer(code._plain(row["text"]), code.dtype), 2).astype("<u4")
        found = rows.pop(row["doc_id"])
        assert (found["start"], found["n_tokens"]) == (start, len(ids))
        assert found["ids_crc32"] == zlib.crc32(ids.tobytes())
        start += len(ids)
    assert not rows


def test_awkward_rows_and_single_documents(spark, awkward, clashing):
    folder = scratch_path(spark, "files")
    manifest = token_files.write_token_files(clashing(awkward), folder, TOKENIZER, 2, 3)
    assert sum(row["docs"] for row in manifest.collect()) == awkward.count()
    rows = token_files.read_token_files(spark, folder).collect()
    assert sorted((r["doc_id"] or -1) for r in rows) == [-1, -1, 1, 2, 3, 4, 5, 5, 6]
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered][2:] == [1, 2, 3, 4, 5, 5, 6]
    at = 0
    for row in ordered:
        assert row["start"] == at and len(row["ids"]) == 4 * row["n_tokens"]
        at += row["n_tokens"]
    five = token_files.read_document(spark, folder, 5)
    assert len(five) == 2 and all(ids[-1] == 2 for ids in five)
    assert token_files.read_document(spark, folder, 77) == []


def test_empty_table_and_foreign_dictionary(spark, awkward):
    folder = scratch_path(spark, "files")
    token_files.write_token_files(awkward.filter("false"), folder, TOKENIZER, 2, 2)
    assert token_files.read_token_files(spark, folder).count() == 0
    token_files.write_token_files(awkward, other := scratch_path(spark, "files"), TOKENIZER, 2, 1)
    files, inner = token_files._place(other)
    with files.open_output_stream(f"{inner}/dictionary.zdict") as out:
        out.write(b"another")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_token_files(spark, other).collect()
