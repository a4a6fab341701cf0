import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import urls
from tallyhouse.llm.queries import URL_RULES

SCHEMA = "page_id bigint, url string, html string, row string, host string, path string, rule string, template string"


def pages(spark, listed):
    return spark.createDataFrame([(i, u, None, "r", "h", "p", "x", "t") for i, u in enumerate(listed)], SCHEMA)


CASES = [
    ("http://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
    ("https://www.Example.NET/en/1?x#y", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/EN/1", "example.net", "/EN/1", "net/", "block"),
    ("http://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
    ("http://a.b.example.com/de/9#top", "a.b.example.com", "/de/9", "example.com/de/", "block"),
    ("http://x.org/fr/2", "x.org", "/fr/2", "org/fr/", "allow"),
    ("http://x.net", "x.net", "", None, "allow"),
    ("http://x.net?y=/", "x.net", "", None, "allow"),
    ("http://planet/x", "planet", "/x", None, "allow"),
    ("http://net/x", "net", "/x", "net/", "block"),
    ("x.net/en", "", "", None, "allow"),
    ("ftp://h://net/x", "h:", "//net/x", None, "allow"),
    ("://net/", "net", "/", "net/", "block"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://ÄÖ.net/ü", "ÄÖ.net", "/ü", "net/", "block"),
    ("http://x.net/a\nb?c", "x.net", "/a\nb", "net/", "block"),
    ("http://x.net/a\nb?c", "x.net", "/a\nb", "net/", "block"),
]


def test_rules_hosts_and_paths(spark):
    got = urls.filter_urls(pages(spark, [c[0] for c in CASES]), URL_RULES).collect()
    assert sorted((r.row.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == sorted((i, *c[1:]) for i, c in enumerate(CASES))


def test_unruled_urls_inherit_their_template(spark):
    """Labels below /shop/<number> are all block, those below /news/<name> all allow."""
    rules = [urls.Rule("block", "h.com", f"/shop/1{i}") for i in range(10)] + [urls.Rule("allow", "h.com", f"/news/n{c}") for c in "abcdefghij"]
    listed = [f"http://h.com/shop/{i}/x" for i in range(100, 200)] + [f"http://h.com/shop/{i}/x" for i in range(900, 950)]
    listed += [f"http://h.com/news/n{c}{i}q{c}" for c in "abcdefghijklmnop" for i in range(3)] + ["http://h.com/about"]
    got = {r.row.url: r for r in urls.filter_urls(pages(spark, listed), rules).collect()}
    assert got["http://h.com/shop/920/x"].rule is None
    assert got["http://h.com/shop/920/x"].template == "shop/#/x"
    assert got["http://h.com/shop/920/x"].verdict == "block"
    assert got["http://h.com/news/np1qp"].verdict == "allow"
    assert got["http://h.com/about"].verdict == "allow"


def test_different_values_become_a_wildcard(spark):
    listed = [f"http://h.com/u/{a}{b}/page" for a in "abcdef" for b in "xyz"]
    rules = [urls.Rule("block", "h.com", f"/u/{a}x") for a in "abcdef"]
    got = urls.filter_urls(pages(spark, listed), rules).collect()
    assert {r.template for r in got} == {"u/*/page"} or {r.template for r in got} == {"*/*/*"}
    assert {r.verdict for r in got} == {"block"}  # 6 labels, all block: 7 / 8


def test_branches_with_other_rates_stay_apart(spark):
    listed = [f"http://h.com/{lang}/{i}" for lang in ("aa", "bb", "cc", "dd") for i in range(50)] + ["http://h.com/ee/1"]
    rules = [urls.Rule("block", "h.com", "/aa/"), urls.Rule("block", "h.com", "/bb/"), urls.Rule("allow", "h.com", "/cc/")]
    got = {r.row.url: r for r in urls.filter_urls(pages(spark, listed), rules).collect()}
    assert got["http://h.com/aa/1"].block_rate > 0.9 and got["http://h.com/cc/1"].block_rate < 0.1
    assert got["http://h.com/dd/1"].block_rate == 0.5 and got["http://h.com/dd/1"].verdict == "allow"


def test_given_labels_and_deep_paths(spark):
    listed = ["http://h.com/a/b/c/d/e/f/" + str(i) for i in range(30)] + [None, ""]
    frame = pages(spark, listed).selectExpr("*", "if(page_id < 20, 'block', null) as label")
    got = urls.filter_urls(frame, [], label_col="label").collect()
    assert {r.verdict for r in got if r.row.url} == {"block"}
    assert {r.verdict for r in got if not r.row.url} == {"allow"}
    kept = urls.allowed(frame.drop("label"), URL_RULES)
    assert kept.columns == frame.columns[:-1]


def test_empty_table(spark):
    assert urls.filter_urls(pages(spark, CASES[0][:1]).limit(0), URL_RULES).count() == 0


@pytest.mark.parametrize("path, segments", [("", [""]), ("/", [""]), ("/a12/b", ["a#", "b"]), ("/1/2/3/4/5/6", ["#", "#", "#", "#", "#/#"])])
def test_segments(spark, path, segments):
    row = spark.createDataFrame([(path,)], "p string").select(urls._segments(urls.F.col("p"))).first()
    assert row[0] == segments


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 6, 7, 9])
def test_variable_segments_at_any_depth(spark, depth):
    """Labelled URLs teach their unlabelled siblings, however deep the variable segment stands."""
    folder = "/".join("abcdefghij"[: depth - 1])
    folder = f"{folder}/" if folder else ""
    names = [f"u{x}{y}" for x in "abcdefghij" for y in "klmnopqr"]
    listed = [f"http://h.com/{folder}{n}/x" for n in names]
    marked = pages(spark, listed).withColumn("mark", F.when(F.col("page_id") < 60, "block"))
    got = urls.filter_urls(marked, [], label_col="mark").collect()
    assert {r.verdict for r in got} == {"block"} and len({r.template for r in got}) == 1


def test_learned_templates_block_and_allow(spark):
    listed = [f"http://h.com/shop/{a}{b}/buy" for a in "abcdefgh" for b in "xyz"] + [f"http://h.com/blog/{a}{b}/read" for a in "abcdefgh" for b in "xyz"]
    marked = pages(spark, listed).withColumn(
        "mark", F.when(F.col("page_id") % 3 == 0, F.when(F.col("url").contains("/shop/"), "block").otherwise("allow"))
    )
    got = urls.filter_urls(marked, [], label_col="mark").collect()
    assert {(r.template, r.verdict) for r in got} == {("shop/*/buy", "block"), ("blog/*/read", "allow")}


def test_a_very_long_url(spark):
    listed = ["http://h.com/" + "seg/" * 50_000 + "x", "http://" + "a" * 100_000 + "/y", None]
    got = {r.row.page_id: r for r in urls.filter_urls(pages(spark, listed), URL_RULES).collect()}
    assert len(got[0].path) == 200_002 and len(got[1].host) == 100_000 and {r.verdict for r in got.values()} == {"allow"}
