import math
import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.llm import urls
from newsloom.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, host string, verdict int"


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule(host, path, rules):
    fits = [(len(t), t, k) for k, t in rules for h, p in [t.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def naive_difference(url, ruled):
    """Interpolated contexts of up to ORDER bytes in dictionaries, without hashing."""
    def grams(u):
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in u.encode())
        for i, b in enumerate(data):
            for k in range(urls.ORDER + 1):
                yield k, tuple(data[i - j] if i >= j else None for j in range(1, k + 1)), b
    total = 0.0
    for kind, sign in (("allow", 1), ("block", -1)):
        one, two = {}, {}
        for u, v in ruled:
            if v == kind:
                for k, past, b in grams(u):
                    one[k, past] = one.get((k, past), 0) + 1
                    two[k, past, b] = two.get((k, past, b), 0) + 1
        p = 1 / 257
        for k, past, b in grams(url):
            if k == 0:
                p = 1 / 257
            p = (two.get((k, past, b), 0) + urls.STRENGTH * p) / (one.get((k, past), 0) + urls.STRENGTH)
            if k == urls.ORDER:
                total += sign * math.log(p)
    return total / max(len(url.encode()), 1)


def test_rules_match_brute_force(spark):
    rng = random.Random(8)
    hosts = ["net", "example.net", "a.example.net", "notexample.net", "EXAMPLE.com", "b.example.com", "org", "x.org", "xorg", "other.io", ""]
    made = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en', '/de/x', '/fr/?a=/en/', '/EN/'])}{rng.choice(['', '?q', '#f', '?u=http://net/'])}"
            for _ in range(300)]
    made += [None, "", "net/en/", "://net/", "a://b://net/", "x\n://example.net/en/\n?", "http://é.net/é"]
    rows = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(made)], SCHEMA)
    got = {r["page_id"]: r for r in urls.filter_urls(rows, URL_RULES).collect()}
    assert len(got) == len(made)
    for i, u in enumerate(made):
        host, path = parts(u)
        want = rule(host, path, URL_RULES)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, want[0]), u
        assert got[i]["verdict"] == want[1] if want[1] else got[i]["verdict"] in ("allow", "block")


def test_model_ratio_matches_brute_force(spark):
    ruled = [("http://Good.org/fr/news", "allow"), ("http://good.org/fr/paper", "allow"), ("http://bad.net/casino", "block"), ("http://bad.net/pills", "block")]
    model = urls.train(spark.createDataFrame([*ruled, (None, "block")], "url string, verdict string"))
    test = ["http://good.io/news", "http://bad.io/casino", "é", ""]
    got = {r["url"]: r["url_score"] for r in urls.rate(spark.createDataFrame([(t, 3) for t in test], "url string, url_score int"), model).collect()}
    for t in test:
        assert got[t] == pytest.approx(naive_difference(t, ruled) if t else 0.0, abs=1e-6)
    assert got[test[0]] > 0 > got[test[1]]


def test_unruled_urls_follow_the_models(spark):
    rng = random.Random(3)
    good = lambda: "/" + "".join(rng.choice(["news", "paper", "book"]) for _ in range(3))
    bad = lambda: "/" + "".join(rng.choice(["casino", "pills", "bet"]) for _ in range(3))
    rows = [(i, f"http://a{i}.org/fr{good()}" if i % 2 else f"http://a{i}.net{bad()}", "h", 1) for i in range(400)]
    rows += [(1000 + i, f"http://z{i}.io{good() if i % 2 else bad()}", "h", 1) for i in range(100)]
    got = urls.filter_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES).where("page_id >= 1000")
    right = got.where((F.col("verdict") == "allow") == (F.col("page_id") % 2 == 1)).count()
    assert right >= 98


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert urls.filter_urls(none, URL_RULES).collect() == []
    one = spark.createDataFrame([(1, None, None, None)], SCHEMA)
    assert tuple(urls.filter_urls(one, []).first())[:4] == (1, "", "", None)
