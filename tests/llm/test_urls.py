import re

import pytest

from gapweave.llm import queries, urls

URLS = [
    "http://www.example.com/en/1?utm_source=x",
    "HTTPS://Blog.EXAMPLE.com/en/2",
    "https://a.b.net/es/3#top",
    "https://net/fr/",
    "https://notnet.org/casino/9",
    "https://mycasino.org/xcasino/9",
    "https://x.org/login",
    "https://x.org/loginpage",
    "https://x.org/docs/login",
    "ftp://m.x.org/a/amp/",
    "https://x.com?x=1",
    "https://x.com",
    "no scheme /casino/",
    "",
    None,
    "https://x.org/" + "a/" * 30_000 + "casino/",
    "https://x.org/p?page=2&a=1",
    "http://one://two/en/",
    "https://İ.net/es/É?É#É",
    "https://x.org/a\nb.zip",
    "https://x.org/a.zip?b",
    "https://x.net:80/es/1",
]


def brute(url):
    """Every rule is tried on every url."""
    lower = {i: i + 32 for i in range(65, 91)}
    url = url or ""
    found = re.search("(?s)://([^/?#]*)([^?#]*)", url)
    host, path = (found[1].translate(lower), found[2]) if found else ("", "")
    fits = [
        r for r in queries.HOST_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if fits:
        rule = max(fits, key=lambda r: len(r.text))
        return host, path, rule.text, rule.verdict
    hits = {r.verdict for r in queries.PATTERN_RULES if re.search(r.regex().replace(r"\z", r"\Z"), url.translate(lower))}
    return host, path, None, "block" if hits == {"block"} else "allow"


def test_equals_trying_every_rule(spark):
    rows = [(n, u, "clash") for n, u in enumerate(URLS)] + [(None, URLS[4], "clash"), (0, URLS[0], "clash")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, verdict string").repartition(2)
    got = urls.judge_urls(pages, queries.HOST_RULES, queries.PATTERN_RULES).collect()
    want = [(i, *brute(u)) for i, u, _ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert urls.judge_urls(pages, queries.HOST_RULES, queries.PATTERN_RULES).collect() == []
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    assert tuple(urls.judge_urls(one, [], []).first()) == (1, "a.b", "/c", None, "allow")


@pytest.mark.parametrize("pattern, tokens", [
    ("/casino/", {"casino"}),
    ("^utm_source=", {"utm", "source"}),
    ("/banner*.gif^", {"gif"}),
    ("feed", set()),
    ("||blog.*/en/", {"blog", "en"}),
    (".zip|", {"zip"}),
])
def test_tokens_are_those_that_every_fitting_url_has(pattern, tokens):
    assert urls.PatternRule(pattern).tokens() == tokens


def test_rules_are_under_their_rarest_token():
    rules = [urls.PatternRule("/a/b/"), urls.PatternRule("open")]
    index = urls.RuleIndex(rules, {"a": 9, "b": 2})
    assert list(index.by_token) == ["b"] and index.always == [rules[1]]
