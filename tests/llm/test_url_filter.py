import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.llm import url_filter as U
from tallyroute.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host int, verdict string, node int"


def run(spark, pages, redirects=None):
    df = spark.createDataFrame([(*p, 1, "v", 2) for p in pages], SCHEMA)
    moved = redirects and spark.createDataFrame(redirects, "source string, target string")
    return {r["page_id"]: r for r in U.judge(df, URL_RULES, moved).collect()}


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("https://A.Example.ORG/es/x?q=/en/1", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://example.org/en/12#top", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://xexample.org/en/12", "xexample.org", "/en/12", "org/", "allow"),
    ("http://org/", "org", "/", "org/", "allow"), ("http://org", "org", "", None, "allow"),
    ("ftp://m.x.com/de/?a", "m.x.com", "/de/", "com/de/", "block"),
    ("http://x.com?u=http://y.org/es/", "x.com", "", None, "allow"),
    ("x.org/es/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("://É.COM/fr/é\n1", "É.com", "/fr/é\n1", "com/fr/", "allow"),
])
def test_longest_rule_decides(spark, url, host, path, rule, verdict):
    r = run(spark, [(1, url, "<p>")])[1]
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def canonical(target):
    return f'<html><LINK data-x="1" href="{target}" rel=canonical><p>'


def test_blocks_reach_aliases_and_explicit_allow_goes_first(spark):
    pages = [
        (1, "https://a.net/1", canonical("https://example.org/es/9")),  # alias of a blocked URL
        (2, "https://a.net/2", canonical("/1")),  # alias of an alias
        (3, "https://a.net/3#x", '<meta content="0; URL=2" http-equiv="Refresh">'),  # relative
        (4, "https://b.net/1", canonical("//x.com/de/1")),
        (5, "https://b.net/2", canonical("https://b.net/1")),
        (6, "https://x.com/fr/1", canonical("https://b.net/2")),  # allow in the same component
        (7, "https://x.com/de/1", None),  # its own rule stays
        (8, "https://c.net/1", canonical("https://c.net/1#self")),
        (9, None, canonical("https://example.org/es/9")),
        (2, "https://a.net/2", None), (10, "https://c.net/7", canonical("")),
        (11, "https://c.net/8", canonical("mailto:x@example.org")),
    ]
    found = run(spark, pages, [("https://c.net/9", "https://A.net/1"), (None, "https://q.net/")])
    verdicts = {k: r["verdict"] for k, r in found.items()}
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow",
                        7: "block", 8: "allow", 9: "allow", 10: "allow", 11: "allow"}
    assert found[1]["by_alias"] and not found[7]["by_alias"] and found[1]["rule"] is None


def test_every_tag_and_dot_segments_count(spark):
    blocked, refresh = "https://example.org/es/9", '<meta http-equiv=refresh content="0; URL={}">'
    found = run(spark, [
        (1, "https://a.net/1", canonical("https://q.net/1") + canonical(blocked)),
        (2, "https://a.net/2", "<link rel=canonical>" + canonical(blocked)),
        (3, "https://a.net/3", refresh.format("https://q.net/3") + refresh.format(blocked)),
        (4, "https://a.net/x/y/4", canonical("../../1")), (5, "https://a.net/./x/../2?q", ""),
        (6, "https://a.net/5", canonical("/x/./../../2?q")), (7, "https://b.net/2?q", ""),
        (8, "https://a.net/8", canonical("/2?q#z")), (9, "https://a.net/2?q", canonical(blocked)),
        (10, "https://a.net/..", ""), (11, "https://a.net/", canonical(blocked))])
    assert {k for k, r in found.items() if r["by_alias"] and r["verdict"] == "block"} == {
        1, 2, 3, 4, 5, 6, 8, 9, 10, 11}


def test_redirect_table(spark):
    found = run(spark, [(1, "http://r.net/a", ""), (2, "http://r.net/b", "")],
                [("http://r.net/a", "http://mid.net/"), ("http://mid.net/", "http://x.com/de/")])
    assert (found[1]["verdict"], found[2]["verdict"]) == ("block", "allow")


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://x.com/de/", None)] * 3,
                               "page_id long, url string, html string")
    assert rows(U.judge(df, URL_RULES).select("page_id", "verdict")) == [(1, "block")] * 3
    assert U.judge(df.limit(0), URL_RULES).count() == 0


def test_links_are_resolved(spark):
    cases = [("b", "http://h.net/x/a", "http://h.net/x/b"), ("/b", "http://h.net/x/a", "http://h.net/b"),
             ("b", "http://h.net", "http://h.net/b"), ("?q=1&amp;r", "http://h.net/x/a", "http://h.net/x/?q=1&r"),
             ("HTTP://Z.net/", "http://h.net/", "HTTP://Z.net/")]
    df = spark.createDataFrame(cases, "target string, base string, want string")
    for found, want in df.select(U.resolve(F.col("target"), F.col("base")), "want").collect():
        assert found == want


TAGS = [
    ('<link rel="nofollow canonical" href="{}">', "block"),
    ("<link href='{}' REL='Canonical next'/>", "block"),
    ("<link\nrel=canonical\nhref={}>", "block"),
    ('<link data-rel="canonical" href="{}">', "allow"),
    ('<link rel="noncanonical" href="{}">', "allow"),
    ('<link rel=canonical-x href="{}">', "allow"),
    ('<link rel="canonical" data-href="{}">', "allow"),
    ('<linkrel rel="canonical" href="{}">', "allow"),
    ('<meta http-equiv="refresh" data-content="0; url={}">', "allow"),
    ('<meta data-http-equiv="refresh" content="0; url={}">', "allow"),
    ('<base href="https://example.org/es/a/"><link rel=canonical href="../9">', "block"),
    ('<base target=_blank><base href="//x.com/de/"><link rel=canonical href="1">', "allow"),
    ('<base href="/q/"><link rel=canonical href="{}">', "block"),
]


def test_tags_are_read_by_attribute_and_word(spark):
    found = run(spark, [(k, f"https://a{k}.net/1", tag.format("https://example.org/es/9"))
                        for k, (tag, _) in enumerate(TAGS)])
    assert [found[k]["verdict"] for k in range(len(TAGS))] == [verdict for _, verdict in TAGS]
