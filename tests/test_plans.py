import gzip
import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException

from viewtide import jobs
from viewtide.operators.series import page_series_docs
from viewtide.parts import manifest
from viewtide.plans import master, trends
from viewtide.sinks import doc_lines, read_serving, write_doc_lines
from viewtide.sources import (
    last_kept_names,
    list_files,
    read_rejects,
    read_series,
    read_top_list,
    read_top_pages,
    scan_lines,
    within_names,
)


@pytest.fixture
def year(tmp_path):
    """Hourly files of two years: page A every hour, page B on one day only."""
    for day in ("20151231", "20160101", "20160102"):
        for hour in (11, 14):
            folder = tmp_path / "raw" / day[:4] / day[4:6]
            folder.mkdir(parents=True, exist_ok=True)
            lines = ["en A 80 0", "en Small 50 0", "de A 900 0", "en x 1"]
            if day == "20160102":
                lines.append('en "B" 70 0')
            (folder / f"pageviews-{day}-{hour}0000.gz").write_bytes(
                gzip.compress("\n".join(lines).encode()))
    return tmp_path


def test_from_raw_files_to_lookups(spark, year, capsys):
    out = str(year / "out")
    for number in ("2015", "2016"):
        jobs.main(["trends", str(year / "raw"), out, "--year", number, "--storage-level", "DISK",
                   "--grains", "day", "week", "month", "year"])
    lists = read_top_pages(spark, f"{out}/top_pages")
    found = {(r.grain, r.interval, r["rank"]): (r.page_title, r.views) for r in lists.collect()}
    assert found == {
        ("day", "20151231", 1): ("A", 160), ("day", "20160101", 1): ("A", 160),
        ("day", "20160102", 1): ("A", 160), ("day", "20160102", 2): ('"B"', 140),
        ("week", "20151227", 1): ("A", 480), ("week", "20151227", 2): ('"B"', 140),
        ("month", "201512", 1): ("A", 160), ("month", "201601", 1): ("A", 320),
        ("month", "201601", 2): ('"B"', 140),
        ("year", "2015", 1): ("A", 160), ("year", "2016", 1): ("A", 320),
        ("year", "2016", 2): ('"B"', 140)}
    series = {r.doc_id: json.loads(r.doc) for r in page_series_docs(
        read_series(spark, f"{out}/series")).collect()}
    assert [p["views"] for p in series["en A"]["dailyViews"]] == ["160", "160", "160"]
    assert series['en "B"']["dailyViews"] == [{"day": "20160102", "views": "140"}]

    jobs.main(["publish", f"{out}/documents", str(year / "serving")])
    docs = {(r.grain, r.doc_id): json.loads(r.doc)
            for r in read_serving(spark, str(year / "serving")).collect()}
    assert set(docs) == {("day", "20151231"), ("day", "20160101"), ("day", "20160102"),
                         ("week", "20151227"), ("month", "201512"), ("month", "201601"),
                         ("year", "2015"), ("year", "2016")}
    assert docs["year", "2016"]["topPages"][1]["pageId"] == 'en "B"'
    report = spark.read.parquet(str(year / "serving" / "reports")).collect()
    assert sum(r.created for r in report) == 8 and sum(r.invalid for r in report) == 0

    jobs.main(["lookup", f"{out}/top_pages", "month", "201601"])
    assert "320" in capsys.readouterr().out


def test_master_and_consolidation(spark, year):
    raw = scan_lines(spark, str(year / "raw" / "*" / "*"), positions=True)
    profile = master.load_master(raw, str(year / "master")).first()
    assert (profile.files, profile.records, profile.bad_records) == (6, 26, 6)
    stored = spark.read.parquet(str(year / "master"))
    assert stored.count() == 20
    assert stored.filter("year = 2016 AND month = 1").count() == 14
    master.load_master(raw, str(year / "first"), limit=2)
    assert spark.read.parquet(str(year / "first")).count() == 12
    master.consolidate(raw, str(year / "stamped"), limit=1)
    assert {r.value for r in spark.read.text(str(year / "stamped")).collect()} == {
        f"{day}{hour}en A 80 0" for day in ("20151231", "20160101", "20160102")
        for hour in ("11", "14")}


def test_stages_sum_everything(spark, year):
    out = str(year / "stages")
    jobs.main(["stages", str(year / "raw" / "*" / "*"), out, "--partitions", "3"])
    stages = {name: {r.value for r in spark.read.text(f"{out}/{name}").collect()}
              for name in ("daily", "weekly", "monthly", "yearly")}
    assert stages["daily"] >= {"20151231en Small\t100", '20160102en "B"\t140'}
    assert stages["weekly"] == {"20151227en A\t480", "20151227en Small\t300",
                                '20151227en "B"\t140'}
    assert stages["monthly"] == {"201512en A\t160", "201512en Small\t100", "201601en A\t320",
                                 "201601en Small\t200", '201601en "B"\t140'}
    assert stages["yearly"] == {"2015en A\t160", "2015en Small\t100", "2016en A\t320",
                                "2016en Small\t200", '2016en "B"\t140'}
    assert len(list((year / "stages" / "daily").glob("part-*"))) <= 3


def test_file_choice_and_options(spark, year):
    source = str(year / "raw" / "*" / "*")
    jobs.main(["trends", source, str(year / "first"), "--files-per-month", "1",
               "--no-threshold", "--grains", "day", "--collapse-ties"])
    lists = read_top_pages(spark, str(year / "first" / "top_pages")).collect()
    assert {(r.interval, r["rank"], r.page_title, r.views) for r in lists} == {
        ("20151231", 1, "A", 80), ("20151231", 2, "Small", 50),
        ("20160101", 1, "A", 80), ("20160101", 2, "Small", 50)}
    jobs.main(["trends", source, str(year / "sample"), "--sample", "--grains", "day"])
    assert read_top_pages(spark, str(year / "sample" / "top_pages")).count() == 0


def test_inventory_job(spark, year):
    pages = [("https://h.example/", '<a href="2016/">'),
             ("https://h.example/2016/", '<a href="pageviews-2016.gz">')]
    spark.createDataFrame(pages, "url STRING, html STRING").write.parquet(str(year / "pages"))
    jobs.main(["inventory", str(year / "pages"), "https://h.example/", str(year / "files")])
    assert [r.url for r in spark.read.parquet(str(year / "files")).collect()] == [
        "https://h.example/2016/pageviews-2016.gz"]


def test_every_line_is_accounted_for(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "pageviews-20160703-110000.gz").write_bytes(gzip.compress("\n".join([
        "en A 1 9999999999", "en B 3000000000 0", "en C x 0", "en D 1", "de E -5 0",
        "en F 99999999999999999999 0", "en G 1 y", "en H 1 99999999999999999999"]).encode()))
    account = master.load_master(scan_lines(spark, str(folder)), str(tmp_path / "out")).first()
    assert (account.records, account.good_records, account.bad_records) == (8, 3, 5)
    assert (account.field_count, account.noninteger_views, account.views_out_of_range,
            account.noninteger_size, account.size_out_of_range) == (1, 1, 1, 1, 1)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == account.written == 3
    assert {r.count_views for r in stored.collect()} == {1, 3000000000, -5}


def test_runs_can_be_repeated(spark, year):
    source, out = str(year / "raw"), year / "again"
    for _ in range(2):
        jobs.main(["stages", source, str(out / "stages")])
        jobs.main(["consolidate", source, str(out / "stamped")])
        jobs.main(["master", source, str(out / "master")])
    assert spark.read.text(str(out / "stamped")).count() == 20
    assert spark.read.parquet(str(out / "master")).count() == 20
    assert "20151231en Small\t100" in {
        r.value for r in spark.read.text(str(out / "stages" / "daily")).collect()}


def test_scopes_are_honoured_or_refused(spark, year, capsys):
    source, out = str(year / "raw"), str(year / "scoped")
    with pytest.raises(ValueError, match="year"):
        jobs.main(["trends", source, out, "--start-month", "1"])
    with pytest.raises((FileNotFoundError, AnalysisException)):
        jobs.main(["trends", source, out, "--year", "2016", "--start-month", "3"])
    jobs.main(["trends", source, out, "--year", "2016", "--end-month", "1", "--grains", "day",
               "--no-threshold"])
    full = spark.read.parquet(f"{out}/daily").count()
    assert full == 5  # both days, three pages at most
    for option in (["--sample"], ["--files-per-month", "1"]):
        with pytest.raises(ValueError, match="output of its own"):
            jobs.main(["trends", source, out, *option])
    assert spark.read.parquet(f"{out}/daily").count() == full


def test_kept_files_are_a_test_inside_the_scan(spark, year):
    source = str(year / "raw")
    files = list_files(spark, source)
    last = last_kept_names(files, 1)
    assert last == {"201512": "pageviews-20151231-110000.gz",
                    "201601": "pageviews-20160101-110000.gz"}
    kept = scan_lines(spark, source, where=within_names(last), recursive=True)
    assert {r.file_name for r in kept.collect()} == set(last.values())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_sunday_and_week_are_both_served(spark, tmp_path):
    day = spark.createDataFrame([("20160703", '{"a":1}', date(2016, 7, 3))],
                                "doc_id STRING, doc STRING, interval_start DATE")
    for grain in ("day", "week"):
        write_doc_lines(doc_lines(day, grain), str(tmp_path / "documents"))
    jobs.main(["publish", str(tmp_path / "documents"), str(tmp_path / "serving")])
    served = read_serving(spark, str(tmp_path / "serving")).collect()
    assert sorted((r.grain, r.doc_id) for r in served) == [
        ("day", "20160703"), ("week", "20160703")]


def hourly(folder, day, *lines):
    path = folder / day[:4] / day[4:6]
    path.mkdir(parents=True, exist_ok=True)
    (path / f"pageviews-{day}-110000.gz").write_bytes(gzip.compress("\n".join(lines).encode()))


@pytest.fixture
def months(tmp_path):
    """Three months whose days straddle weeks, with pages that come and go."""
    source = tmp_path / "raw"
    for day in ("20160628", "20160630", "20160701", "20160702", "20160731", "20160801"):
        hourly(source, day, *[f"en P{i} {100 + (i * int(day[-2:])) % 97} 0" for i in range(12)],
               f"en Only{day[4:6]} 500 0", f"en Day{day} 300 0", "en - 9 0", "de A 900 0",
               "en x 1", "en x 1", "en T\t1 2 3", "en N one 0")
    return tmp_path


def everything(spark, out):
    lists = sorted(map(tuple, read_top_pages(spark, f"{out}/top_pages").collect()))
    series = sorted((r.page_id, tuple(map(tuple, r.daily_views)))
                    for r in read_series(spark, f"{out}/series").collect())
    docs = sorted((r.value, r.grain, r.year)
                  for r in spark.read.text(f"{out}/documents").collect())
    rejects = sorted(map(tuple, read_rejects(spark, f"{out}/rejects").collect()))
    return lists, series, docs, rejects


GRAINS = trends.TrendOptions(top_n=4, grains=("day", "week", "month", "year"))


def test_monthly_loads_equal_one_load(spark, months):
    """Months loaded one after the other, one of them again after a change, against all
    at once."""
    source, step = months / "raw", str(months / "step")
    for month in ("06", "07", "08"):
        trends.build_trends(scan_lines(spark, str(source / "2016" / month)), step, options=GRAINS)
    hourly(source, "20160702", "en P1 900 0", "en New 800 0", "en P3 101 0", "en bad")
    account = trends.build_trends(
        scan_lines(spark, str(source / "2016" / "07")), step, options=GRAINS).first()
    assert account.lines == account.kept + account.rejected
    once = str(months / "once")
    total = trends.build_trends(
        scan_lines(spark, str(source / "*" / "*")), once, options=GRAINS).first()
    assert everything(spark, step) == everything(spark, once)
    assert total.lines == total.kept + total.rejected == 5 * 20 + 4
    assert total.rejected == total.domain + total.hyphen_title + total.quarantined
    assert sum(r.copies for r in read_rejects(spark, f"{once}/rejects").collect()) \
        == total.quarantined == 5 * 4 + 1
    trends.build_trends(scan_lines(spark, str(source / "2016" / "08")), step, options=GRAINS,
                        rebuild=True)
    assert everything(spark, step) == everything(spark, once)


def test_a_load_writes_only_what_it_touches(spark, months):
    source, out = months / "raw", str(months / "out")
    trends.build_trends(scan_lines(spark, str(source / "*" / "*")), out, options=GRAINS)
    before = manifest(spark, f"{out}/top_pages"), manifest(spark, f"{out}/series")
    hourly(source, "20160801", "en P1 900 0", "en Day20160801 300 0")
    trends.build_trends(scan_lines(spark, str(source / "2016" / "08")), out, options=GRAINS)
    after = manifest(spark, f"{out}/top_pages"), manifest(spark, f"{out}/series")
    written = {part for part, folder in after[0].items() if before[0].get(part) != folder}
    # The first of August lies in the week that starts on the last of July.
    assert written == {"day-201608", "week-201607", "month-201608", "year-2016"}
    assert any(before[1].get(part) == folder for part, folder in after[1].items())
    top = read_top_list(spark, f"{out}/top_pages", "day", "20160801")
    assert {r.page_title for r in top.collect()} == {"P1", "Day20160801"}
    assert len(top.inputFiles()) == 1


def test_text_is_read_once(spark, months, monkeypatch):
    """A single job scans the text: facts, rejects and counts come out of it."""
    scans = []
    stage = trends._stage
    monkeypatch.setattr(trends, "_stage", lambda raw, options: scans.append(raw) or stage(
        raw, options))
    raw = scan_lines(spark, str(months / "raw" / "*" / "*"))
    trends.build_trends(raw, str(months / "out"), options=GRAINS)
    assert len(scans) == 1
    staged, account = stage(raw.filter("value LIKE 'de %'"), GRAINS)
    assert (account.first().lines, account.first().domain) == (6, 6)
    assert "text" not in staged._jdf.queryExecution().executedPlan().toString().lower()


def test_audited_load(spark, year, monkeypatch):
    raw = scan_lines(spark, str(year / "raw" / "*" / "*"))
    sound = master.load_master(raw, str(year / "sound"), audit=True).first()
    assert (sound.written, sound.damaged) == (20, 0)
    assert master.load_master(raw, str(year / "plain")).first().damaged is None
    real = master.write_master

    def lossy(records, path):
        real(records, path)
        spark.read.parquet(path).limit(1).drop("year", "month").write.mode("append").parquet(
            f"{path}/year=2016/month=1")
    monkeypatch.setattr(master, "write_master", lossy)
    assert master.load_master(raw, str(year / "lossy"), audit=True).first().damaged == 1
