import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from formmart.llm.url_filter import MAX_RULES, Rule, UrlTrie, filter_urls

RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/"), Rule("block", "org", "/fr"), Rule("block", "a.org", "/x/y"),
         Rule("allow", "a.org", "/x/y/z/"), Rule("allow", "", "/free/")]


def brute(host, path):
    fits = [r for r in RULES if (not r.host or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host.split(".")) if r.host else 0, len(r.path)), default=None)


labels = st.sampled_from(["net", "org", "example", "com", "a", "b", ""])
segments = st.sampled_from(["en", "fr", "de", "french", "x", "y", "yy", "z", "", "free"])


@settings(max_examples=300, deadline=None)
@given(st.lists(labels, max_size=4).map(".".join), st.lists(segments, max_size=4).map(lambda s: "/".join(["", *s]) if s else ""))
def test_longest_match(host, path):
    assert UrlTrie(RULES).find(host, path) == brute(host, path)


def test_block_wins_between_equal_rules():
    for rules in ([Rule("allow", "x", "/"), Rule("block", "x", "/")], [Rule("block", "x", "/"), Rule("allow", "x", "/")]):
        assert UrlTrie(rules).find("x", "/").action == "block"


def test_edges(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?q=/de/", "http://x.net", "http://x.net/", "http://notnet/",
            "https://u@a.org:80/fr/", "ftp://example.com/de/#/x", "://org/fr/\n", "http://exaMPLE.org/FR/", "x://net?://y"]
    df = spark.createDataFrame([(i, u, "mine", "h") for i, u in enumerate(urls)] + [(None, urls[3], "mine", "h"), (5, urls[5], "mine", "h")],
                               "page_id long, url string, verdict string, host string")
    rows = filter_urls(df, RULES[:4]).collect()
    assert len(rows) == len(urls) + 2
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows if r.page_id is not None}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[4] == ("x.net", "", None, "allow")  # an empty path doesn't start with the rule's
    assert got[5] == ("x.net", "/", "net/", "block")
    assert got[6][2:] == (None, "allow")
    assert got[7] == ("u@a.org:80", "/fr/", None, "allow")
    assert got[8] == ("example.com", "/de/", "example.com/de/", "block")
    assert got[9][2:] == ("org/fr/", "allow")
    assert got[10][:3] == ("example.org", "/FR/", None)
    assert got[11] == ("net", "", None, "allow")
    assert filter_urls(df.limit(0), RULES).count() == 0


def test_too_many_rules_are_refused(spark):
    with pytest.raises(ValueError):
        filter_urls(spark.createDataFrame([("u",)], "url string"), [Rule("block", "x")] * (MAX_RULES + 1))
