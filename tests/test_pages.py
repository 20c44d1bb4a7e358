import json
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.config import Collection
from corpusloom.functions.html import page_parts, read_page
from corpusloom.functions.urls import netloc, reader_for, url_allowed, url_path
from corpusloom.operators import pages as pg
from corpusloom.operators.crawl import crawl
from corpusloom.sources import tables

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma "
META = f"""<html><head><title> A <b>Title</b> </title>
<meta name="Description" content="upper"><meta name="description" content="first"><meta name="description" content="second">
<meta name="keywords" content="a, b,c"><meta name="author" content="Ann"><meta name="empty" content="">
<meta property="og:title" content="One"><meta property="og:title" content="Two"><meta property="og:none">
<meta name="twitter:card" content="card"><meta http-equiv="content-language" content="nl">
<link rel="canonical" href="https://a.example/x"></head><body><article>{WORDS * 3}</article></body></html>"""
DATA = f"""<html lang="en"><body><script type="application/ld+json">{{"a": 1}}</script>
<script type="application/ld+json">{{bad</script><script type="application/ld+json"></script>
<div itemscope itemtype="T"><span itemprop="p" content="attr">text</span><i itemprop="q"> in <b>side</b></i></div>
<div itemscope itemtype="Empty"></div><article>{WORDS * 3}</article></body></html>"""


def pages(spark, *rows):
    data = [(i, url, html) for i, (url, html) in enumerate(rows)]
    return spark.createDataFrame(data, "page_id long, url string, html string")


def main(html, **options):
    return " ".join(read_page(html, "http://h.example/", False, options.get("whole", False))["main_text"].split())


def test_metadata(spark):
    row = pg.page_records(pages(spark, ("http://u@h.example:8/p?q", META))).first()
    meta = row["metadata"]
    assert row["title"] == "A Title" and row["language"] == "nl"
    assert meta["domain"] == "u@h.example:8"
    assert meta["description"] == "first" and meta["author"] == "Ann"
    assert meta["keywords"] == ["a", " b", "c"]
    assert meta["meta_tags"]["description"] == "second" and "empty" not in meta["meta_tags"]
    assert meta["meta_tags"]["content-language"] == "nl"
    assert meta["open_graph"] == {"og:title": "Two", "og:none": ""}
    assert meta["twitter_card"] == {"twitter:card": "card"}
    assert meta["canonical_url"] == "https://a.example/x"
    assert meta["response_status"] is None and meta["content_length"] == len(META.encode())
    assert row["content_stats"]["word_count"] == 54


def test_structured_data(spark):
    rows = pages(spark, ("http://h.example/", DATA))
    found = pg.page_records(rows).first()["metadata"]["structured_data"]
    assert [d["type"] for d in found] == ["json-ld", "microdata"]
    assert json.loads(found[0]["json"]) == {"a": 1}
    assert found[1]["itemtype"] == "T"
    assert found[1]["properties"] == {"p": "attr", "q": "inside"}
    after = pg.page_records(rows, after_cleanup=True).first()["metadata"]["structured_data"]
    assert [d["type"] for d in after] == ["microdata"]


def test_main_content_fallbacks():
    assert main("<main>a<article>b</article></main>") == "a b b"
    assert main("<div class='PostBody'>x</div><div class='other'>y</div>") == "x"
    assert main("<p>too short</p><p>long enough <b>text</b></p><li>1234567890</li>") == "long enoughtext"
    assert main("<article></article><p>long enough text</p>") == ""
    assert main("<div class='read-more'>x</div><div class='content'>y</div>") == "y"
    assert main("<div class='read-more content'>x</div>", whole=True) == "x"
    assert main("<article><p><b>a<br><p>c</p></article><footer>no</footer>") == "a c"
    assert main("<article>a &amp;&lt; b<!-- c --><script>var t = '</p>';</script></article>") == "a &< b"
    assert main("<article>&amp&am;&ampx &#65;&#x42; a<!-- split -->b c&eacute;d</article>") == "&&am&ampx AB a b c\u00e9d"
    assert main("<article>1 < 2 <br/>3</article></div>") == "1 < 2 3"


def test_language_order(spark):
    english = "the and or but in on at to for of " * 12
    rows = pages(
        spark,
        ("http://h.example/1", f"<html lang=''><body><article>{english}</article></body></html>"),
        ("http://h.example/2", f"<html><body><article>{WORDS * 3}</article></body></html>"),
        ("http://h.example/3", f"<meta http-equiv='content-language'><article>{WORDS * 3}</article>"),
    )
    found = pg.page_records(rows, keep=("page_id",)).orderBy("page_id").collect()
    assert [r["language"] for r in found] == ["en", "unknown", "unknown"]


def test_links(spark):
    html = """<nav><a href='b'>1</a><a href='../c?x=1#f'>2</a><a href='?q'>3</a><a href='http://other.example/'>4</a>
    <a href='javascript:x'>5</a><a href='mailto:x'>6</a><a href='tel:1'>7</a><a href='#x'>8</a>
    <a href='/pic.JPG'>9</a><a href='b'>10</a><a>11</a><a href='//h.example/d'>12</a></nav>"""
    rows = pages(spark, ("http://h.example/d/a", html))
    found = [(r["position"], r["dst"]) for r in pg.internal_links(rows).orderBy("position").collect()]
    assert found == [
        (0, "http://h.example/d/b"),
        (1, "http://h.example/c?x=1#f"),
        (2, "http://h.example/d/a?q"),
        (3, "http://h.example/d"),
    ]
    assert pg.internal_links(rows, after_cleanup=True).count() == 0


def test_links_of_pages_that_repeat_a_url(spark):
    url = "http://h.example/a"
    rows = pages(spark, (url, "<a href='/x'>1</a><a href='/y'>2</a>"), (url, "<a href='/z'>1</a><a href='/x'>2</a>"))
    found = [(r["src"], r["dst"], r["position"]) for r in pg.internal_links(rows).orderBy("position").collect()]
    assert found == [(url, f"http://h.example/{name}", i) for i, name in enumerate("xzy")]


def test_url_parts(spark):
    urls = ["http://u:p@H.example:80/a/b;x=1?q#f", "//n.example/p", "no/scheme", "http://h.example/é |.gif", ""]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    found = frame.select(netloc(F.col("u")), url_path(F.col("u"))).collect()
    assert [tuple(r) for r in found] == [
        ("u:p@H.example:80", "/a/b"), ("n.example", "/p"), ("", "no/scheme"),
        ("h.example", "/é |.gif"), ("", ""),
    ]
    rules = Collection(allowed_domains=("h.example",), blocked_domains=("u:p",))
    allowed = [r[0] for r in frame.select(url_allowed(F.col("u"), rules)).collect()]
    assert allowed == [False, False, False, False, False]
    assert [r[0] for r in frame.select(url_allowed(F.col("u"))).collect()] == [True, True, True, False, True]


def test_readers(spark):
    paths = ["https://x/a.pdf", "A.PDF", "b.docx", "c.md", "d.HTML", "e.csv", "f.json", "g.xls", ".txt", "h.tar.txt"]
    frame = spark.createDataFrame([(p,) for p in paths], "p string")
    found = [r[0] for r in frame.select(reader_for(F.col("p"))).collect()]
    assert found == ["web", "pdf", "docx", "text", "html", "csv", "json", "unsupported", "unsupported", "text"]


def breadth_first(seed, links, valid, limit, per_page):
    """The queue rule in plain Python."""
    queue, seen, found = [seed], {seed}, []
    for url in queue:
        if len(found) == limit:
            break
        if url not in valid:
            continue
        if valid[url]:
            found.append(url)
        if len(found) < limit:
            fresh = [u for u in links.get(url, [])[:per_page] if u not in seen]
            queue += fresh
            seen.update(fresh)
    return found


def test_crawl_equals_a_queue(spark):
    rng = random.Random(9)
    urls = [f"u{i}" for i in range(60)]
    links = {u: rng.sample(urls + ["gone1", "gone2"], rng.randint(0, 7)) for u in urls}
    valid = {u: rng.random() < 0.8 for u in urls}
    seeds = urls[:6] + ["gone1"]
    found = crawl(
        spark.createDataFrame([(s, s) for s in seeds], "seed string, url string"),
        spark.createDataFrame(
            [(s, d, i) for s, ds in links.items() for i, d in enumerate(ds)], "src string, dst string, position int"
        ),
        spark.createDataFrame(list(valid.items()), "url string, valid boolean"),
        Collection(max_pages_per_source=15, links_per_page=3),
    ).collect()
    for seed in seeds:
        got = [r["url"] for r in sorted((r for r in found if r["seed"] == seed), key=lambda r: r["rank"])]
        assert got == breadth_first(seed, links, valid, 15, 3)


def test_crawl_collects_the_valid_pages_of_a_repeated_url(spark):
    table = [("a", True), ("a", True), ("a", False), ("b", True), ("c", False), ("c", False)]
    found = crawl(
        spark.createDataFrame([("s", "a")], "seed string, url string"),
        spark.createDataFrame([("a", "c", 0), ("a", "b", 1)], "src string, dst string, position int"),
        spark.createDataFrame(table, "url string, valid boolean"),
    ).collect()
    assert sorted(tuple(r) for r in found) == [("s", "a", 0, 1), ("s", "a", 0, 2), ("s", "b", 1, 3)]


def test_failures_are_counted(spark):
    good = spark.createDataFrame([("web", "x")], "source_type string, content string")
    bad = spark.createDataFrame([("pdf", "broken")], "source_type string, error string")
    rows = pg.collect_sources(good, bad)
    outcome = {r["source_type"]: (r["succeeded"], r["failed"]) for r in pg.source_outcomes(rows).collect()}
    assert outcome == {"web": (1, 0), "pdf": (0, 1)}


NESTED = {
    "divs": ('<div class="content">word ' * 4000, "too much text"),
    "articles": ("<article>word " * 4000, "too much text"),
    "items": ('<div itemscope itemtype="T"><span itemprop="p">value</span>' * 4000, "too much text"),
    "bold": ("<b>" * 20_000 + "<p>x</p></i>" * 20_000, None),
    "table": ("<p><table>" + "<b>" * 20_000 + "<p>text of a paragraph</p>" * 10_000, None),
}


@pytest.mark.parametrize("name", sorted(NESTED))
def test_nested_pages_take_linear_time(name):
    html, problem = NESTED[name]
    start = time.perf_counter()
    if problem:
        with pytest.raises(ValueError, match=problem):
            read_page(html, "", False, False)
    else:
        read_page(html, "", False, False)
    assert time.perf_counter() - start < 2


def test_a_page_nested_beyond_measure_is_a_row_with_its_error(spark):
    rows = [(1, "http://h.example/a", NESTED["divs"][0]), (2, "http://h.example/b", "<article>fine text here</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["page"] for r in pages.select("page_id", page_parts(F.col("html"), F.col("url")).alias("page")).collect()}
    assert "too much text" in found[1]["error"] and found[1]["main_text"] is None
    assert found[2]["error"] is None and found[2]["main_text"] == "fine text here"


def test_few_pages_are_held_at_once(spark, tmp_path):
    count = 3 * tables.PAGES_PER_BATCH + 7
    rows = [(i, f"http://h.example/{i}", None if i % 9 == 4 else f"<title>t{i}</title>") for i in range(count)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    read = tables.pages(spark, str(tmp_path)).coalesce(1)
    size = F.arrow_udf(lambda ids: pa.array([len(ids)] * len(ids), pa.int32()), "int")(F.col("page_id"))
    assert read.select(size.alias("n")).agg(F.max("n")).first()[0] <= tables.PAGES_PER_BATCH
    parts = page_parts(F.col("html"), F.col("url"), wanted=("title",))
    found = read.select("page_id", parts.alias("p")).select("page_id", "p.title").collect()
    assert {r["page_id"]: r["title"] for r in found} == {i: html and f"t{i}" for i, _, html in rows}


def test_parts_of_a_page():
    html = ("<title> A <b>b</b></title><script itemprop='s'>x<i>y</i></script><div itemscope itemtype='T'><p itemprop='a'>one <b> two</b>"
            "<script>no</script></p><div itemtype='U'><i itemprop='c' content='z'>w</i></div></div><a href='/l'>k</a>"
            "<article>text <article>in <style>s</style>side</article></article>")  # fmt: skip
    page = read_page(html, "http://h.example/", False, False)
    assert page["title"] == "A b" and page["links"] == ["http://h.example/l"]
    assert page["microdata"] == [
        {"itemtype": "T", "properties": [{"name": "a", "value": "onetwo"}, {"name": "c", "value": "z"}]},
        {"itemtype": "U", "properties": [{"name": "c", "value": "z"}]},
    ]
    assert page["main_text"] == "text in side\n\nin side"
    only = read_page(html, "http://h.example/", False, False, frozenset({"links"}))
    assert only == {"links": ["http://h.example/l"]}
    after = read_page(html, "http://h.example/", True, False, frozenset({"links", "main_text"}))
    assert after["links"] == page["links"] and after["main_text"] == page["main_text"]
