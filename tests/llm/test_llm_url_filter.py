import pytest
from hypothesis import given
from hypothesis import strategies as st

from vendaria.llm.registry import URL_RULES
from vendaria.llm.url_filter import ALLOW, BLOCK, Rule, UrlTrie, filter_urls, judge_urls, split_url


def fitting(rules, host, path):
    fits = [
        r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host), r.verdict == BLOCK), default=None)


PART = st.sampled_from(["a", "b", "org", "example", "", "A"])
HOST = st.lists(PART, min_size=1, max_size=4).map(".".join)
PATH = st.lists(st.sampled_from(["", "a", "ab", "en", "1", "12"]), max_size=4).map(lambda p: "/" + "/".join(p))
RULES = st.lists(st.builds(Rule, st.sampled_from([ALLOW, BLOCK]), HOST.map(str.lower), PATH), max_size=8)


@given(RULES, HOST, PATH)
def test_longest_rule_wins(rules, host, path):
    assert UrlTrie(rules).longest(host.lower(), path) == fitting(rules, host.lower(), path)


@pytest.mark.parametrize(
    ("url", "host", "path"),
    [
        (None, "", ""),
        ("", "", ""),
        ("no scheme/x", "", ""),
        ("https://Ex.ORG/Es/1?q=/a#b", "ex.org", "/Es/1"),
        ("https://É.org?x/y", "É.org", ""),
        ("x://h#a?b/c", "h", ""),
        ("x://a/b://c", "a", "/b://c"),
    ],
)
def test_split(url, host, path):
    assert split_url(url) == (host, path)


def test_edge_cases(spark):
    rows = [
        (1, "https://sub.example.org/en/12", "x"),
        (2, "https://example.org/es/", "x"),
        (3, "https://a.net/", "x"),
        (4, None, None),
        (5, "https://org", "x"),
        (5, "https://org", "x"),
        (6, "https://x.com/de/" + "y" * 100_000, "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    found = [(r["page_id"], r["v"]["rule"], r["v"]["verdict"], r["rule"]) for r in judge_urls(pages, URL_RULES, output="v").collect()]
    assert found == [
        (1, "example.org/en/1", BLOCK, "x"),
        (2, "example.org/es/", BLOCK, "x"),
        (3, None, ALLOW, "x"),
        (4, None, ALLOW, None),
        (5, None, ALLOW, "x"),
        (5, None, ALLOW, "x"),
        (6, "com/de/", BLOCK, "x"),
    ]
    assert [r["page_id"] for r in filter_urls(pages, URL_RULES).collect()] == [3, 4, 5, 5]
    assert filter_urls(pages, URL_RULES, default=BLOCK).columns == pages.columns
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert judge_urls(pages, []).count() == 7
    with pytest.raises(ValueError, match="at most"):
        judge_urls(pages, URL_RULES, max_rules=2)
    with pytest.raises(ValueError, match="allows or blocks"):
        judge_urls(pages, [Rule("drop", "org", "/")])
