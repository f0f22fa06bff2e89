from pyspark.sql import functions as F

from strata.sources import index_pages as ip

INDEX = """<html><body><h1>Index</h1>
<a href="?C=N;O=D">Name</a><a href="?C=M;O=A">Last modified</a>
<a href="?C=S;O=A">Size</a><a href="?C=D;O=A">Description</a>
<a href="../">Parent Directory</a>
<a href="pda-024-icb-SP-2026_02.zip">pda-024-icb-SP-2026_02.zip</a>
<!-- <a href="commented.zip">x</a> -->
<script>var s = '<a href="scripted.zip">';</script>
<A HREF='http://host/dir/a%20b.zip?x=1#frag'>upper</A>
<a class="c" href="/x/y.zip;v=2">params</a>
<a href="k&amp;r.zip">entity</a>
</body></html>"""

PERIODS = """<a href="../">..</a><a href="201903/">201903/</a><a href="201904/">201904/</a>
<a href="202602/">202602/</a><a href="202603/">202603/</a><a href="not-a-period/">x</a>"""


def test_file_links_from_index_page(spark):
    pages = spark.createDataFrame([(1, INDEX)], "page_id long, html string")
    names = sorted(r.file_name for r in ip.page_file_links(pages).collect())
    assert names == ["a b.zip", "k&r.zip", "pda-024-icb-SP-2026_02.zip", "y.zip"]


def test_all_hrefs_in_order(spark):
    pages = spark.createDataFrame([(1, '<a href="a">1</a><p><a id="x" href="b">2</a>')], "page_id long, html string")
    assert [r.href for r in ip.page_links(pages).collect()] == ["a", "b"]


def test_periods_in_range_inclusive(spark):
    pages = spark.createDataFrame([(1, PERIODS)], "page_id long, html string")
    links = ip.page_links(pages)
    got = sorted(r.period for r in ip.periods_in_range(links, "href", "201904", "202602").collect())
    assert got == ["201904", "202602"]
    latest = ip.latest_period(ip.periods_in_range(links, "href")).collect()
    assert [r.period for r in latest] == ["202603"]
    assert ip.latest_period(ip.periods_in_range(links.limit(1), "href")).count() == 0


def test_file_filters(spark):
    df = spark.createDataFrame(
        [("pda-024-icb-SP-2026_02.zip",), ("pda-024-icb-XX-2026_02.zip",), ("?C=N;O=D",), ("file.csv",), ("A.ZIP",)],
        "name string",
    )
    allowed = [r.name for r in df.where(ip.file_allowed(F.col("name"), [".zip"], ["xx"])).collect()]
    assert allowed == ["pda-024-icb-SP-2026_02.zip", "A.ZIP"]


def test_unpublished_skips_existing(spark):
    periods = spark.createDataFrame([("202601",), ("202602",)], "period string")
    published = spark.createDataFrame([("202602",)], "period string")
    latest = ip.latest_period(periods)
    assert ip.unpublished(latest, published).count() == 0
    assert [r.period for r in ip.unpublished(periods, published).collect()] == ["202601"]


CASES = [
    ('<a href="//cdn.example.com">x</a>', None),
    ('<a href="//cdn.example.com/f.zip">x</a>', "f.zip"),
    ('<a href="a&#x2e;zip">x</a>', "a.zip"),
    ('<a href="b&#46;zip&amp;amp;x">x</a>', "b.zip&amp"),
    ('<a href="p%ZZ%20q.zip">x</a>', "p%ZZ q.zip"),
    ('<a href="a+b%2Bc.zip">x</a>', "a+b+c.zip"),
    ('<a title="a>b" href="gt.zip">x</a>', "gt.zip"),
    ("<a title='it\"s>' HREF = 'sq.zip' >x</a>", "sq.zip"),
    ("<a href=bare.zip class=c>x</a>", "bare.zip"),
    ('<a href="first.zip" href="last.zip">x</a>', "last.zip"),
    ('<a data-href="no.zip">x</a>', None),
    ('<a href="">x</a><a>y</a><abbr href="no.zip">z</abbr>', None),
    ('<a href="&#233;%C3%A9.zip">x</a>', "éé.zip"),
    (None, None),
]


def test_link_spellings(spark):
    pages = spark.createDataFrame([(i, html) for i, (html, _) in enumerate(CASES)], "page_id long, html string")
    got = {r.page_id: r.file_name for r in ip.page_file_links(pages).collect()}
    assert got == {i: name for i, (_, name) in enumerate(CASES) if name is not None}


def test_character_references_are_read_as_an_html_parser_does(spark):
    import html
    from html.entities import html5

    texts = ["&notin;", "&not", "&notit;", "&copy2", "&copy=2&amp;b", "&amp;amp;", "a&b&c", "&;", "&", "&&amp;", "&#", "&#x", "&#;", "&# 1;"]
    texts += [f"x&#{n}y&#x{n:x};" for n in (0, 1, 9, 10, 13, 31, 38, 65, 127, 128, 0x81, 0x9F, 0xA0, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000)]
    texts += ["&#00000000000000065;", "&#x000000000000041", "&#99999999999999999999999;", "&#xFFFFFFFFFFFFFFFFFF;", "&unknown;", "&" + "a" * 40 + ";"]
    texts += [f"p&{name}q" for name in html5] + [f"&{name[:-1]}" for name in html5 if name.endswith(";")]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", ip.html_entities(F.col("t")).alias("d"))
    got = {r.i: r.d for r in rows.collect()}
    wrong = [(t, got[i], html.unescape(t)) for i, t in enumerate(texts) if got[i] != html.unescape(t)]
    assert not wrong
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan  # the lists are read once, not per reference
