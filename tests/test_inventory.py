import pytest

from viewtide.operators import inventory

ROOT = "https://dumps.example.org/"


def hrefs(spark, html):
    pages = spark.createDataFrame([(1, html)], "page_id INT, html STRING")
    return [r.href for r in inventory.extract_links(pages).orderBy("pos").collect()]


@pytest.mark.parametrize("html, expected", [
    ('<a href="x">x</a><A class=y HREF="z/">', ["x", "z/"]),
    ("<a href='single'>", ["single"]),
    ("<a href=bare>", ["bare"]),
    ('<a\n  title="t"\n  href = "x">', ["x"]),
    ('<a data-href="no">', []),
    ('<a name="n">', []),
    ('<abbr href="no">', []),
    ('<!-- <a href="no"> --><a href="yes">', ["yes"]),
    ('<script>var t = \'<a href="no">\';</script><a href="yes">', ["yes"]),
    ('<a href="?a=1&amp;b=&quot;2&quot;">', ['?a=1&b="2"']),
    ('<a href="&amp;lt;">', ["&lt;"]),
    ('<a href="">', [""]),
    ('<a title="a>b" href="x">', ["x"]),
    ('<a title="x href=y" href="z">', ["z"]),
    ("<a disabled data-x='1' href=z>", ["z"]),
    ('<a href="&#65;&#x42;&#38;lt;&amp;#65;&#0;">', ["AB&lt;&#65;\ufffd"]),
    ('<a href="yes"><!-- open <a href="no">', ["yes"]),
])
def test_anchor_hrefs(spark, html, expected):
    assert hrefs(spark, html) == expected


def test_whole_href_must_match(spark):
    links = spark.createDataFrame([(h,) for h in (
        "2016/", "2016-07/", "2016", "x2016/", "pageviews-20160701-110000.gz",
        "pageviews-20160701-110000.gz.md5", "../")], "href STRING")
    classes = {r.href: r.link_class for r in inventory.classify_links(links).collect()}
    assert [h for h, c in classes.items() if c == "directory"] == ["2016/", "2016-07/"]
    assert [h for h, c in classes.items() if c == "data_file"] == ["pageviews-20160701-110000.gz"]


def test_walk_reaches_every_level_once(spark):
    def page(*links):
        return "".join(f'<a href="{link}">' for link in links)
    pages = spark.createDataFrame([
        (ROOT, page("2015/", "2016/", "2016/2016-07/", "../", "2017/")),
        (ROOT + "2015/", page("pageviews-2015.gz")),
        (ROOT + "2016/", page("2016-07/", "pageviews-2016.gz")),
        (ROOT + "2016/2016-07/", page("pageviews-20160701-110000.gz", "readme.html", "2016-07/")),
        (ROOT + "2016/2016-07/2016-07/", page("pageviews-2016-deep.gz")),
        ("https://elsewhere.example.org/", page("pageviews-2016.gz")),
    ], "url STRING, html STRING")
    found = inventory.with_file_name(inventory.list_data_files(pages, ROOT)).collect()
    assert sorted(r.url for r in found) == sorted([
        ROOT + "2015/pageviews-2015.gz", ROOT + "2016/pageviews-2016.gz",
        ROOT + "2016/2016-07/pageviews-20160701-110000.gz",
        ROOT + "2016/2016-07/2016-07/pageviews-2016-deep.gz"])
    assert {r.file_name for r in found} >= {"pageviews-2015.gz"}
    assert inventory.list_data_files(
        spark.createDataFrame([(ROOT, '<a href="">')], "url STRING, html STRING"), ROOT,
        directory=".*").count() == 0
    assert inventory.list_data_files(pages, "https://nowhere.example.org/").count() == 0


def test_a_walk_beyond_the_bound_is_an_error(spark):
    pages = spark.createDataFrame(
        [(ROOT + "2016/" * i, '<a href="2016/"><a href="pageviews-2016.gz">') for i in range(4)],
        "url STRING, html STRING")
    assert inventory.list_data_files(pages, ROOT, levels=4).count() == 4
    with pytest.raises(Exception, match="more than 3 directory levels"):
        inventory.list_data_files(pages, ROOT, levels=3).collect()


def test_pages_that_link_to_themselves_end(spark):
    pages = spark.createDataFrame(
        [(ROOT, '<a href="2016/"><a href="2016/"><a href="pageviews-2016.gz">'),
         (ROOT + "2016/", '<a href=""><a href="2016/"><a href="pageviews-2016.gz">')],
        "url STRING, html STRING")
    assert inventory.list_data_files(pages, ROOT, directory=".*/|").count() == 2
