import random

import pytest

from trackcast.llm.url_filter import RULES, WildcardAutomaton, filter_urls, parse_glob

CLASH = "host string, path string, rule string, verdict string, id string"


def brute(url, rules=RULES):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), v == "block", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[2], max(fit)[3]
    return host, path, None, "block" if "casino" in host or "free-bet" in host else "allow"


def urls():
    rng = random.Random(11)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "xexample.com", "EXAMPLE.Com", "example.net", "net", "a.org",
             "casino-win.org", "m.free-bets.example.net", "example.com:80", "é.com", "example.com.", ".com", ""]
    paths = ["", "/", "/en", "/en/", "/EN/", "/en/x", "/es/1", "/fr/", "//en/", "/a/www.example.com/en/", "/é/\n/en/"]
    tails = ["", "?q=/en/", "#top", "?a#b", "#a?b"]
    out = [f"{rng.choice(['http', 'HTTPS', '', 'a b'])}://{h}{p}{rng.choice(tails)}" for h in hosts for p in paths]
    return out + [None, "", "example.com/en/", "http:/example.com/en/", "http://a://b.com/en/", "://", "x://y.com/" + "a/" * 40_000,
                  "x://" + "y" * 70_000 + ".com/en/"]


@pytest.mark.parametrize("clash", [False, True])
def test_equals_brute_force(spark, clash):
    rows = list(enumerate(urls())) + [(3, "http://a.com/en/"), (3, "http://a.com/en/"), (None, "http://b.net/es/")]
    if clash:
        pages = spark.createDataFrame([(*r, "h", "p", "r", "v", "i") for r in rows], f"page_id long, url string, {CLASH}")
    else:
        pages = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted([tuple(r) for r in filter_urls(pages).collect()], key=repr)
    assert got == sorted([(k, *brute(u)) for k, u in rows], key=repr)


def test_rules_over_many_words(spark):
    rng = random.Random(12)
    rules = [(rng.choice(["allow", "block"]), f"{a}{b}.org", p) for a in "abcdefgh" for b in "xyz" for p in ("/", "/q/", "/q/r")]
    rows = [(i, f"http://{rng.choice(['', 's.', 's'])}{rng.choice('abcdefghi')}{rng.choice('xyz')}.org{rng.choice(['', '/', '/q', '/q/', '/q/r/s'])}")
            for i in range(300)]
    got = {r["page_id"]: tuple(r)[1:] for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).collect()}
    assert got == {k: brute(u, rules) for k, u in rows}


def test_wildcards():
    globs = ["a*c", "a**c", "?b", "**", "", "*", "a***b*"]
    texts = ["ac", "abbc", "ab/c", "/b", "xb", "", "a", "a/xb", "a/xb/", "acc"]
    import re
    plain = ["a[^/]*c", "a.*c", "[^/]b", ".*", "", "[^/]*", "a.*[^/]*b[^/]*"]
    got = WildcardAutomaton([parse_glob(g) for g in globs]).fits([t.encode() for t in texts])
    assert got.tolist() == [[re.fullmatch(p, t) is not None for p in plain] for t in texts]


def test_globs_and_otherwise(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x.exe"), (2, "http://a.b/x.txt"), (3, "http://a.b/safe/x.exe"), (4, None)], "page_id int, url string")
    globs = (("block", "**.exe"), ("allow", "*/safe/**.exe"))
    got = filter_urls(pages, rules=(), globs=globs, otherwise="block")
    assert dict(got.dtypes)["page_id"] == "int"
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == {1: "block", 2: "block", 3: "allow", 4: "block"}


def test_empty_table(spark):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
