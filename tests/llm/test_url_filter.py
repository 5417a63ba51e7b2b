"""URL filter against a plain reading of the rules."""

import pytest

from stationlake.llm import url_filter as U

PAGES = "page_id BIGINT, url STRING, html STRING, host STRING, path STRING, rule STRING"
URLS = [
    "http://a.example.net/en/1", "https://example.net/en/", "http://EXAMPLE.net/de/x?y#z", "http://notexample.net/en/1",
    "http://x.example.com/de/1", "http://x.example.com/fr/1", "http://deep.er.org/fr/", "http://org/fr/a", "http://netorg/fr/",
    "http://b.net", "http://b.net?x=/", "http://b.net#/", "ftp://b.net/", "b.net/en/", "", None, "://", "http://", "http:///en/",
    "http://b.net:80/en/", "http://u@b.net/x", "http://a..net/y", "http://b.net./y", "http://a://b.net/", "http://é.NET/En/",
    "http://" + "s." * 3000 + "net/" + "p" * 20_000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:end], rest[end:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    end = min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))
    return host, rest[:end]


def judged(url, rules):
    host, path = parts(url)
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[3:] if fit else (None, "allow")))


@pytest.mark.parametrize("rules", [U.RULES, (), (("b.net", "", "block"), ("net", "/y", "allow"), ("a.b", "/q", "block"), ("b.net", "", "allow"))])
def test_against_plain_rules(spark, rules):
    rows = [(i if i != 3 else None, u, None, "x", "y", "z") for i, u in enumerate(URLS * 2)]
    frame = spark.createDataFrame([], "host STRING, path STRING, verdict STRING") if not rules else U.rules_frame(spark, rules)
    got = U.judge_urls(spark.createDataFrame(rows, PAGES), frame)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(key, got.collect())) == sorted(key((r[0], *judged(r[1], rules))) for r in rows)


def test_a_null_rule_fits_nothing_and_no_pages_give_no_rows(spark):
    rules = U.rules_frame(spark, [(None, "/", "block"), ("net", None, "block")])
    pages = spark.createDataFrame([(1, "http://b.net/x")], "page_id BIGINT, url STRING")
    assert [tuple(r) for r in U.judge_urls(pages, rules).collect()] == [(1, "b.net", "/x", None, "allow")]
    assert U.judge_urls(pages.limit(0), U.rules_frame(spark)).count() == 0
