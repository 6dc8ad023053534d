import json

import pytest
from pyspark.sql import functions as F

from viewtide import sinks
from viewtide.operators import bloom, documents, ranking, rollup, series


def test_documents_round_trip_to_ranked_rows(facts):
    titles = ['Say_"hi"', "Back\\slash", "Comma,_page", "Ünï_cøde", "a/b"]
    ranked = ranking.top_pages(facts(*[("2016-07-01", t, 200 + i) for i, t in enumerate(titles)]),
                               "day", 10)
    nested = documents.nest_top_pages(ranked, "https://example.org/")
    row = documents.interval_docs(nested).first()
    parsed = json.loads(row.doc)
    assert row.doc_id == parsed["interval"] == "20160701"
    expected = [{"rank": str(i), "pageId": f"en {t}", "url": f"https://example.org/{t}",
                 "topic": t.replace("_", " "), "views": str(205 - i)}
                for i, t in enumerate(reversed(titles), 1)]
    assert parsed["topPages"] == expected
    assert list(parsed["topPages"][0]) == ["rank", "pageId", "url", "topic", "views"]
    ids = documents.unnest_top_page_ids(documents.interval_docs(nested))
    assert {r.page_id for r in ids.collect()} == {f"en {t}" for t in titles}


def test_arrays_are_in_rank_order_and_bounded(facts):
    rows = [("2016-07-01", f"P{i:04d}", 1000 - i // 2) for i in range(200)]
    nested = documents.nest_top_pages(ranking.top_pages(facts(*rows), "day", 20)).first()
    assert [p["rank"] for p in nested.top_pages] == list(range(1, 21))
    views = [p.views for p in nested.top_pages]
    assert views == sorted(views, reverse=True)


def test_validity(spark):
    docs = ['{"a":"b"}', '{"a":"\\q"}', "{a:1}", "", '{"a":', None]
    frame = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)],
                                  "value STRING, doc STRING")
    assert [r.valid for r in documents.with_validity(frame).orderBy("value").collect()] == [
        True, False, False, False, False, False]


def test_series_of_popular_pages(facts):
    daily = facts(("2016-07-02", "A", 300), ("2016-07-01", "A", 200), ("2016-07-01", "B", 150),
                  ("2016-08-01", "C", 110), ("2016-08-01", "A", 400))
    tops = [ranking.top_pages(f, g, 1) for f, g in (
        (daily, "day"), (rollup.monthly_views(daily), "month"))]
    popular = series.popular_page_ids(*tops)
    assert [r.page_title for r in popular.collect()] == ["A"]
    nested = series.page_series(series.popular_daily_views(daily, popular))
    doc = series.page_series_docs(nested).first()
    assert doc.doc_id == "en A"
    assert json.loads(doc.doc) == {"pageId": "en A", "dailyViews": [
        {"day": "20160701", "views": "200"}, {"day": "20160702", "views": "300"},
        {"day": "20160801", "views": "400"}]}


@pytest.fixture
def bucketed(spark, tmp_path):
    """Facts of 3,000 pages in buckets, and 40 popular ones on disk."""
    facts = spark.range(30000).select(
        F.date_add(F.lit("2016-01-01").cast("date"), (F.col("id") / 3000).cast("int")).alias("day"),
        F.lit("en").alias("domain_code"), F.concat(F.lit("P"), F.col("id") % 3000).alias(
            "page_title"), F.col("id").alias("views"))
    sinks.write_bucketed_facts(facts, "facts_in_buckets", str(tmp_path / "facts"), 6)
    facts.filter("id % 3000 % 75 = 0").select("domain_code", "page_title").distinct(
    ).write.parquet(str(tmp_path / "popular"))
    yield spark.table("facts_in_buckets"), spark.read.parquet(str(tmp_path / "popular"))
    spark.sql("DROP TABLE facts_in_buckets")


def test_bucketed_facts_are_not_exchanged(spark, bucketed, set_conf):
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts, popular = bucketed
    kept = series.popular_daily_views(facts, popular, prefilter=True)
    assert kept.count() == 400
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # Of the two sides only the popular pages pass an exchange; the bitmap has its own.
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 6 out of 6" in plan
    assert plan.count("Exchange hashpartitioning(domain_code") == 1


@pytest.mark.parametrize("bits", [1 << 20, 1 << 12, 64])
def test_the_bitmap_loses_no_key(spark, bucketed, bits):
    facts, popular = bucketed
    passed = bloom.maybe_in(facts, popular, ["domain_code", "page_title"], bits)
    exact = facts.join(popular, ["domain_code", "page_title"], "left_semi")
    assert passed.join(popular, ["domain_code", "page_title"], "left_semi").count() == 400
    assert exact.select(*passed.columns).exceptAll(passed).isEmpty()
    if bits == 1 << 20:
        assert passed.count() == 400
    assert bloom.maybe_in(facts, popular.filter("false"), ["domain_code", "page_title"],
                          bits).isEmpty()
