from pathlib import Path

import pytest
from pyspark.sql import functions as F

from viewtide import sinks, sources
from viewtide.operators import documents
from viewtide.plans import publish


def put(folder: Path, name: str, *lines: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


@pytest.fixture
def loaded(spark, tmp_path):
    """Two files; the second repeats an id and repairs a broken document."""
    put(tmp_path / "in" / "a", "part-0", '(20160701,{"v":"1"})', "", '(20160702,{"v":"\\q"})',
        '(20160703,{"v":"1"})', '(20160703,{"v":"2"})')
    put(tmp_path / "in" / "b", "part-0", '(20160701,{"v":"9"})', "(20160704,no document)",
        '(20160702,{"v":"3"})')
    return sources.read_doc_lines(spark, str(tmp_path / "in"))


def contents(frame):
    return {r.doc_id: r.doc for r in frame.collect()}


EXPECTED = {"20160701": '{"v":"9"}', "20160702": '{"v":"3"}', "20160703": '{"v":"2"}'}


def test_lines_split_at_the_document(spark, tmp_path):
    put(tmp_path / "in", "part-0", '(en Foo,_bar,{"pageId":"en Foo,_bar","x":[1,{"y":2}]})')
    row = sources.read_doc_lines(spark, str(tmp_path / "in")).first()
    assert (row.doc_id, row.doc) == ("en Foo,_bar", '{"pageId":"en Foo,_bar","x":[1,{"y":2}]}')


def test_last_document_wins(loaded):
    assert contents(sinks.upsert_docs(None, documents.valid_json_docs(loaded))) == EXPECTED
    assert documents.invalid_json_docs(loaded).count() == 2


def test_many_copies_of_one_id(spark):
    """One id holds almost all rows; only its last copy remains."""
    rows = spark.range(20000).select(
        F.when(F.col("id") % 50 == 0, F.col("id").cast("string")).otherwise("hot").alias("doc_id"),
        F.lit("f").alias("file_path"), F.lit(0).alias("block_start"), F.col("id").alias("line_id"),
        F.col("id").cast("string").alias("doc"))
    found = contents(sinks.latest_docs(rows))
    assert len(found) == 401 and found["hot"] == "19999"


def test_published_versions(spark, loaded, tmp_path):
    path = str(tmp_path / "serving")
    with pytest.raises(FileNotFoundError):
        sinks.read_serving(spark, path)
    valid = documents.valid_json_docs(loaded)
    sinks.publish_docs(valid.filter(F.col("file_path").contains("/a/")), path)
    assert contents(sinks.read_serving(spark, path))["20160701"] == '{"v":"1"}'
    sinks.publish_docs(valid.filter(F.col("file_path").contains("/b/")), path)
    assert contents(sinks.read_serving(spark, path)) == EXPECTED


def test_unrecorded_version_is_invisible(spark, loaded, tmp_path):
    path = str(tmp_path / "serving")
    valid = documents.valid_json_docs(loaded)
    sinks.publish_docs(valid, path)
    spark.createDataFrame([("x", "half")], "doc_id STRING, doc STRING").write.parquet(
        f"{path}/data/000001/_part=00-of-64")
    assert contents(sinks.read_serving(spark, path)) == EXPECTED
    sinks.publish_docs(valid, path)
    assert contents(sinks.read_serving(spark, path)) == EXPECTED


def test_load_report(spark, loaded, tmp_path):
    known = spark.createDataFrame([("20160703", "{}")], "doc_id STRING, doc STRING")
    report = {r.file_path[-8:]: tuple(r)[1:] for r in sinks.load_report(loaded, known).collect()}
    # lines, blank, invalid, loaded, created, updated
    assert report == {"a/part-0": (5, 1, 1, 3, 1, 2), "b/part-0": (3, 0, 1, 2, 1, 1)}
    first = publish.load_documents(spark, str(tmp_path / "in"), str(tmp_path / "serving"))
    assert {r.file_path[-8:]: r.created for r in first.collect()} == {"a/part-0": 2, "b/part-0": 1}
    again = publish.load_documents(spark, str(tmp_path / "in"), str(tmp_path / "serving"))
    assert sum(r.created for r in again.collect()) == 0


def test_overwrite_one_year(spark, tmp_path):
    path = str(tmp_path / "years")
    table = spark.createDataFrame([("a", 2015), ("b", 2016), ("c", 2016)], "doc STRING, year INT")
    sinks.overwrite_year(table, path)
    sinks.overwrite_year(spark.createDataFrame([("d", 2016)], "doc STRING, year INT"), path)
    schema = "doc STRING, year INT"
    assert {(r.doc, r.year) for r in sinks.read_years(spark, path, schema).collect()} == {
        ("a", 2015), ("d", 2016)}
    assert [r.doc for r in sinks.read_years(spark, path, schema, 2015).collect()] == ["a"]


def test_failed_write_leaves_the_old_year(spark, tmp_path):
    """A task that fails after others have written files."""
    path, schema = str(tmp_path / "years"), "doc STRING, year INT"
    sinks.overwrite_year(spark.createDataFrame([("a", 2015), ("b", 2016)], schema), path)
    rows = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") == 3999, F.raise_error(F.lit("lost"))).otherwise("x").cast(
            "string").alias("doc"), (F.col("id") % 2 + 2015).cast("int").alias("year"))
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite_year(rows, path)
    kept = {(r.doc, r.year) for r in sinks.read_years(spark, path, schema).collect()}
    assert kept == {("a", 2015), ("b", 2016)}
    sinks.overwrite_year(spark.createDataFrame([("c", 2016)], schema), path)
    assert {r.doc for r in sinks.read_years(spark, path, schema).collect()} == {"a", "c"}


def test_export_is_gzip(spark, tmp_path):
    path = tmp_path / "export"
    lines = spark.createDataFrame([("(1,{})",), ("(2,{})",)], "value STRING")
    sinks.export_compressed(lines, str(path))
    assert [p for p in path.glob("*.gz")]
    assert {r.value for r in spark.read.text(str(path)).collect()} == {"(1,{})", "(2,{})"}


def batch(spark, ids, text):
    return spark.createDataFrame([(str(i), text) for i in ids], "doc_id STRING, doc STRING").select(
        "*", F.lit("day").alias("grain"), F.lit("f").alias("file_path"),
        F.lit(0).alias("block_start"), F.lit(0).alias("line_id"))


def test_a_load_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "serving")
    first = sinks.publish_docs(batch(spark, range(2000), "{}"), path, buckets=32)
    assert len(first) == 32
    files = set(sinks.read_serving(spark, path).inputFiles())
    reader = sinks.read_serving(spark, path, version=0)
    changed = sinks.publish_docs(batch(spark, [5, 9000], '{"new":1}'), path, buckets=7)
    assert 1 <= len(changed) <= 2
    now = sinks.read_serving(spark, path)
    assert len(files & set(now.inputFiles())) == 32 - len(changed)
    found = contents(now)
    assert len(found) == 2001 and found["5"] == found["9000"] == '{"new":1}'
    assert contents(reader)["5"] == "{}" and reader.count() == 2000
    one = sinks.read_document(spark, path, "day", "9000")
    assert one.first().doc == '{"new":1}' and len(one.inputFiles()) == 1
    assert sinks.read_document(spark, path, "week", "9000").count() == 0
    assert sinks.publish_docs(batch(spark, [], "{}").limit(0), path) == []


def test_old_versions_can_be_dropped(spark, tmp_path):
    path = str(tmp_path / "serving")
    for text in ("1", "2", "3"):
        sinks.publish_docs(batch(spark, range(50), text), path, buckets=4)
    dropped = sinks.drop_old_versions(spark, path, keep=2)
    assert len(dropped) == 4 and all(place.startswith("data/000000/") for place in dropped)
    assert set(contents(sinks.read_serving(spark, path)).values()) == {"3"}
    assert sinks.read_serving(spark, path, version=1).count() == 50
    assert sinks.drop_old_versions(spark, path, keep=2) == []
