"""Operator 1: the cascade is exact, rules as written."""

import random

import pytest

from ledgerlens.llm import url_cascade as U

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"))


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "key string")


@pytest.mark.parametrize("n_listed, n_all, shard_bytes", [(0, 50, 1 << 20), (50, 50, 1 << 20), (300, 4000, 1 << 20), (700, 3000, 128)])
def test_membership_is_exact(spark, n_listed, n_all, shard_bytes):
    names = [f"k{i}é" for i in range(n_all)]
    listed = random.Random(1).sample(names, n_listed)
    cascades = U.build(keys(spark, [*listed, "outside"]), keys(spark, names), shard_bytes)
    if shard_bytes < 1000:
        assert len(cascades) > 2
    rows = spark.createDataFrame([(i, names[i:i + 7]) for i in range(0, n_all, 7)] + [(-1, [])], "i int, keys array<string>")
    got = {k: h for r in U.contains(rows, "keys", "hits", cascades).collect() for k, h in zip(r["keys"], r.hits, strict=True)}
    assert got == {k: k in set(listed) for k in names}


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:].split("?")[0].split("#")[0]
    fit = [r for r, _ in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fit, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "http://example.com/en", "http://example.com/en/", "http://a.b.example.com/en/1", "http://notexample.com/en/1",
        "x://y.net/es/", "x://net/es/é", "x://.net/es/", "http://example.com", "http://example.com?/en/", "a://b://com/", "http://com/\nx", "http://É.com/", "http://z.org/" + "p" * 50_000,
        "http://" + "a." * 20_000 + "com/", "http://user@host.com:80/en/"]


def test_judging(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*URLS, URLS[6], "http://t.org/a?1", "http://t.org/a?2"])] + [(None, "http://q.com/", "h")], "page_id long, url string, host string")
    split = pages.select("url", U.url_host(pages.url).alias("host"), U.url_path(pages.url).alias("path"))
    out = U.judge(pages, RULES, U.repeat_addresses(split)).collect()
    assert len(out) == len(URLS) + 4
    verdicts, urls = dict(RULES), {}
    for u in [*URLS, "http://t.org/a?1", "http://t.org/a?2", "http://q.com/"]:
        urls.setdefault(brute(u)[:2], set()).add(u)
    for r in out:
        if r.page_id is not None and r.page_id < len(URLS):
            assert (r.host, r.path, r.rule) == brute(URLS[r.page_id])
        assert r.verdict == (verdicts[r.rule] if r.rule else "block" if r.host and len(urls[r.host, r.path]) > 1 else "allow")
    assert sum(r.host == "t.org" for r in out) == 2


def test_empty_and_wrong_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    blocked = spark.createDataFrame([("a/",), (None,)], "address string")
    assert U.judge(none, RULES, blocked).count() == 0
    with pytest.raises(ValueError):
        U.judge(none, (("com/", "maybe"),), blocked)
