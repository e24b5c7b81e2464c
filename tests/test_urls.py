"""Link extraction and address resolution against Python's own HTML parser and URL functions."""

from html.parser import HTMLParser
from posixpath import basename
from urllib.parse import urljoin

import pytest
from conftest import DATA

from tierloom.functions.urls import hrefs, resolve
from tierloom.operators.listing import discover_links, reconcile


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        href = dict(attrs).get("href")
        if tag == "a" and href is not None:
            self.found.append(href)


def anchors(page: str) -> list[str]:
    parser = Anchors()
    parser.feed(page)
    parser.close()
    return parser.found


PAGES = [
    '<a href="x.txt">x</a><A HREF="Y.TXT">y</A>',
    "<a class='k' href='single'>s</a><a href=bare>b</a><a\n  href = \"spaced\"  >s</a>",
    '<a title="a > b" href="after-quote">q</a><a data-href="no" href="yes">d</a>',
    "<a title='x href=\"inner\"' href=\"outer\">t</a><a name=\"none\">n</a><a>n</a>",
    '<!-- <a href="hidden">h</a> --><a href="shown">s</a>',
    '<script>var t = "<a href=\'scripted\'>";</script><a href="real">r</a><style>a[href="x"]{}</style>',
    '<a href="?a=1&amp;b=2">e</a><a href="&quot;q&quot;">q</a><abbr href="not-an-anchor">n</abbr>',
    '<a disabled href="flag">f</a><a href="">empty</a><area href="map">',
    "no links at all",
    "",
]


@pytest.mark.parametrize("page", PAGES)
def test_hrefs_as_a_parser_finds_them(spark, page):
    (row,) = spark.createDataFrame([(page,)], "html string").select(hrefs("html").alias("h")).collect()
    assert row["h"] == anchors(page)


BASES = [
    "http://a.example/b/c/d;p?q=1",
    "https://a.example/pub/time.series/pr/",
    "http://a.example",
    "http://a.example/x?y#top",
]
ADDRESSES = [
    "g", "./g", "g/", "/g", "//other/g", "?y=2", "g?y", "#s", "g#s", "g?y#s", "", ".", "./", "..", "../", "../g",
    "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "..g", "./../g", "./g/.", "g/./h",
    "g/../h", "http://else/h/../i", "mailto:x@y", "/pub/time.series/pr/pr.data.0.Current", "a//b", " /lead",
    "x:y", "1x:y", "g?y/./x", "g#s/../x", "/a/b/", "é.txt",
]


@pytest.mark.parametrize("base", BASES)
def test_resolution(spark, base):
    df = spark.createDataFrame([(base, address) for address in ADDRESSES], "base string, address string")
    got = {r["address"]: r["r"] for r in df.select("address", resolve("base", "address").alias("r")).collect()}
    assert got == {address: urljoin(base, address) for address in ADDRESSES}


def test_links_of_all_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    expected = {
        (basename(href), urljoin(row["url"], href))
        for row in pages.collect()
        for href in anchors(row["html"])
        if not href.endswith("/") and basename(href)
    }
    links = discover_links(pages).collect()
    assert len(links) == len(expected) and {tuple(r) for r in links} == expected


def test_a_directory_listing(spark):
    page = '<a href="/pub/">Up</a><a href="/pub/pr/pr.data.1.AllData">x</a><a href="/pub/pr/pr.series">y</a>'
    df = spark.createDataFrame([("https://h/pub/pr/", page)], "url string, html string")
    assert sorted(tuple(r) for r in discover_links(df).collect()) == [
        ("pr.data.1.AllData", "https://h/pub/pr/pr.data.1.AllData"),
        ("pr.series", "https://h/pub/pr/pr.series"),
    ]


def test_reconcile_strips_only_the_stamp(spark):
    landed = spark.createDataFrame(
        [("pr.data.1.AllData.20260814120000",), ("pr.data.1.AllData.20260815120000",), ("pr.old.20260814120000",),
         ("population_20260814T120000.json",)],
        "f string",
    )
    listed = spark.createDataFrame([("pr.data.1.AllData",), ("pr.series",), ("population",)], "n string")
    got = {r["name"]: r["status"] for r in reconcile(landed, listed, "f", "n").collect()}
    assert got == {
        "pr.data.1.AllData": "present", "pr.old": "stale", "pr.series": "missing", "population": "present",
    }


def test_resolution_stays_in_the_jvm(spark):
    plan = discover_links(spark.read.parquet(f"{DATA}/pages.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan
