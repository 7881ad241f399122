"""Url verdicts against a plain reading of the rules."""

import random
import re

import numpy as np
import pytest
import xxhash

from runlens.llm import urls

#: The five rules of the query's contract, written out.
CONTRACT = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
RULES = [*CONTRACT, ("m.example.com/en/x", "allow"), ("org", "block"), ("a.org/", "allow"), ("net/es/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match("[^?#]*", rest[len(host) :])[0]


def plain(url, rules, blocked):
    host, path = split(url)
    best = None
    for rule, verdict in rules:
        h, s, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(s + p):
            if best is None or (len(rule), len(h)) > (len(best[0]), len(best[0].partition("/")[0])):
                best = (rule, verdict)
    if best:
        return host, path, *best
    hit = any(host == b or host.endswith("." + b) for b in blocked)
    return host, path, None, "block" if hit else "allow"


def random_urls(rng, n):
    out = [None, "", "no scheme", "://", "http://", "https://EXAMPLE.com", "HTTP://Www.Example.Com/en/a?b#c", "x://net/es/", "x://a.net/ES/", "http://com/", "http://example.com#/en/", "a://b://example.com/en/", "http://spam-farm.example.org/x", "http://É.com/é?ü", "http://user@host:80/p"]
    for _ in range(n):
        host = ".".join(rng.choice(["www", "m", "example", "a", "B", "com", "net", "org", "spam-farm"]) for _ in range(rng.randrange(1, 5)))
        out.append(f"http://{host}" + rng.choice(["", "/", "/en/", "/en", "/es/1", "/fr/", "/fr/b?c", "/FR/", "/en/x", "?q", "#h", "/en/x?/es/"]))
    return out


@pytest.mark.parametrize("most", [urls.MOST_BYTES, 0])
def test_verdicts(spark, most):
    cases = random_urls(random.Random(8), 600)
    df = spark.createDataFrame([(i, u, "mine", "old") for i, u in enumerate(cases)], "page_id long, url string, html string, verdict string")
    out = urls.judge(df, RULES, urls.BLOCKED_HOSTS, most_bytes=most)
    assert out.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    got = {r["page_id"]: tuple(r)[3:] for r in out.collect()}
    assert got == {i: plain(u, RULES, urls.BLOCKED_HOSTS) for i, u in enumerate(cases)}
    assert urls.judge(df, RULES, urls.BLOCKED_HOSTS, most_bytes=most).count() == len(cases)  # the same list once more


def test_collisions_are_confirmed(tmp_path, monkeypatch):
    """With a digest of two values nearly all keys collide; the stored strings still decide."""
    real = xxhash.xxh64_intdigest
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda x, *a: real(x, *a) % 2)
    keys = {urls._key(0, h, s + p): v == "block" for h, s, p, v in ((*r.partition("/"), v) for r, v in RULES)}
    keys |= {urls._key(1, h, ""): True for h in urls.BLOCKED_HOSTS}
    lengths = sorted({len(s + p) for r, _ in RULES for _, s, p in [r.partition("/")]})
    (tmp_path / "d").write_bytes(urls.DigestArray.build(list(keys), list(keys.values()), lengths))
    array = urls.DigestArray.open(str(tmp_path / "d"))
    assert isinstance(array.digests, np.memmap) and (np.diff(array.digests.astype(int)) >= 0).all()
    for u in random_urls(random.Random(9), 200):
        assert (*split(u), *array.judge([split(u)[0]], [split(u)[1]])[0]) == plain(u, RULES, urls.BLOCKED_HOSTS)


def test_edges(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(df).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/")], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge(one, (), ()).collect()] == ["allow", "allow"]
    with pytest.raises(Exception, match="no rule: com/"):
        urls.judge(one, [("com/", "maybe")])


def test_the_contracts_rules(spark):
    """Each rule of the contract decides something, with its verdict."""
    assert dict(urls.RULES) == dict(CONTRACT)
    cases = ["http://a.com/", "http://m.example.com/en/x", "http://www.example.com/en/x", "http://b.net/es/1", "http://b.net/fr/1", "http://b.net/de/1"]
    df = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(df).collect()}
    assert got == dict(enumerate([*CONTRACT, (None, "allow")]))


@pytest.mark.parametrize("most", [urls.MOST_BYTES, 0])
def test_a_million_hosts_from_a_table(spark, most, monkeypatch):
    n = 1_000_000
    monkeypatch.setattr(urls, "PART_BYTES", 8 << 20)
    hosts = spark.range(n).selectExpr("concat('h', id, '.Example.org') as host").union(spark.createDataFrame([(None,)], "host string"))
    rules = spark.createDataFrame([*CONTRACT, ("com/", "allow"), (None, "block")], "rule string, verdict string")
    pages = spark.range(0, 2 * n, 1000).selectExpr("id as page_id", "concat('http://www.h', id, '.example.org/x') as url")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, rules, hosts, most_bytes=most).collect()}
    assert got == {i: (None, "block" if i < n else "allow") for i in range(0, 2 * n, 1000)}
