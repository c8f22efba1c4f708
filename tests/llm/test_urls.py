"""URL verdicts: parsing and rules against a plain restatement, the tree against its SQL and on made hosts."""

import random
import re

import duckdb
import pytest

from tidepanel.llm import urls

PAGES = "page_id long, url string, html string, host string, template string, purity double, n long"


def plain(url):
    """(host, path, rule, verdict of the rule)."""
    if url is None or "://" not in url:
        return "", "", None, None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule in urls.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best, urls.RULES.get(best)


ODD = [
    None, "", "nothing", "://", "http://", "http://net", "http://net/", "http://x.net?a/b", "http://xnet/", "HTTPS://WWW.Example.NET/en/5", "http://example.net/en", "http://example.net/EN/1",
    "http://badexample.com/de/1", "http://a.example.com/de/", "http://a.org/fr/?x", "http://org/fr/x#y", "ftp://u:p@Example.com:80/de/x", "http://a.org/fr", "a://b://c/d", "http://é.Ä.org/fr/ü",
    "http://a.net/en/\nx", "http://example.net//en/1", "http://a.com/" + "s/" * 500 + "9" * 3000, "http://a.com/deadBEEFdeadBEEF0/x12y", "http://example.net/en/ä?b", "http://.net/", "http://a.com/ /%20", "http://net.org/fr/",
]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(12)
    made = [f"http://{h}.example.{d}/{p}/{rng.randint(1, 999)}{e}" for h in ("a", "b", "a") for d in ("com", "net", "org") for p in ("en", "de", "fr", "es") for e in ("", "", "/", ".html", "?q=1") for _ in range(rng.randint(0, 5))]
    rows = [(i, u, "x", "h", "t", 0.5, 1) for i, u in enumerate(ODD + made)]
    return spark.createDataFrame([*rows, rows[9], rows[9], (None, ODD[9], None, None, None, None, None)], PAGES)


def test_rows_and_rules(table):
    got = urls.judge_urls(table, urls.RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    rows, of = got.collect(), {r.page_id: r.url for r in table.collect()}
    assert len(rows) == table.count()
    for r in rows:
        *found, verdict = plain(of[r.page_id])
        assert [r.host, r.path, r.rule] == found, of[r.page_id]
        assert r.verdict == (verdict or ("block" if r.purity >= 0.5 else "allow"))


def test_the_tree_equals_its_sql(table):
    pages = table.select("page_id", "url").toArrow()  # noqa: F841
    want = duckdb.sql(urls.ORACLE_SQL).fetchall()
    got = urls.judge_urls(table, urls.RULES).select("page_id", "host", "path", "rule", "verdict", "template").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_templates_of_a_host(spark):
    """Many articles merge, a branch of blocked urls stays apart, and unlabelled urls follow their template."""
    rng = random.Random(1)
    rows = [(f"http://h.com/news/story{w}", "allow" if rng.random() < 0.3 else None) for w in "abcdefghijklmnopqrst" for _ in range(5)]
    rows += [(f"http://h.com/go/{rng.randint(1, 9999)}", "block" if k % 2 else None) for k in range(60)]
    rows += [(f"http://h.com/{y}/{m}", None) for y in ("about", "help", "terms") for m in ("us", "it", "all") for _ in range(3)]
    pages = spark.createDataFrame([(i, u, known) for i, (u, known) in enumerate(rows)], "page_id long, url string, known string")
    got = urls.judge_urls(pages, {}, label="known").collect()
    news, go, rest = ([r for r in got if (part := r.path.split("/")[1]) in names or (not names and part not in ("news", "go"))] for names in (["news"], ["go"], []))
    assert {r.verdict for r in go} == {"block"} and {r.template for r in go} == {"/go/{n}"} and {r.rule for r in got} == {None}
    assert {r.verdict for r in news + rest} == {"allow"} and len({r.template for r in news}) <= 2
    assert {r.template.split("/")[1][0] for r in rest} == {"*"}


def test_empty_and_unlabelled_tables(spark):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), urls.RULES).collect() == []
    got = urls.judge_urls(spark.createDataFrame([(1, "http://a/b/c"), (2, None)], "page_id long, url string"), {}).collect()
    assert {(r.page_id, r.verdict) for r in got} <= {(1, "block"), (1, "allow"), (2, "allow"), (2, "block")} and len(got) == 2
