import random

import pytest

from wardline.llm import urlfilter
from wardline.llm.queries import URL_RULES
from wardline.sources.layers import materialize


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def rule_of(host, path):
    fits = []
    for verdict, rule in URL_RULES:
        name, tail = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org", "http://example.org/", "http://a.example.org/es/1?x#y",
    "http://example.org/en/1", "http://example.org/en/12", "http://notexample.org/en/1", "http://x.com/fr/", "http://x.com/de/a",
    "http://x.com/DE/a", "https://com/fr/", "http://org", "http://a.b?c://d/e", "http://a#b/c", "x://y://z/fr/", "http://ÉX.com/fr/é",
    "http://spam.net/a", "http://SPAM.net/\nb", "http://spam.org/", "http://" + "a" * 5000 + ".com/fr/" + "b" * 100_000,
]


def test_pages_match_brute_force(spark, clash):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://x.com/fr/1"), (3, URLS[3])]
    pages = clash(spark.createDataFrame(rows, "page_id long, url string"))
    got = urlfilter.judge(pages, URL_RULES, lambda h: h.startswith("spam"), materialize).collect()
    want = []
    for i, url in rows:
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        want.append((i, host, path, rule, verdict or ("block" if host.startswith("spam") else "allow")))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    none = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge(none, URL_RULES, lambda h: h.startswith("spam"), materialize).collect() == []


@pytest.mark.parametrize("listed, others", [(0, 50), (50, 0), (1, 3000), (1500, 1500), (40, 9000)])
def test_cascade_is_exact_for_its_universe(spark, listed, others):
    rng = random.Random(listed)
    rows = [(f"k{rng.random()}", n < listed) for n in range(listed + others)]
    universe = spark.createDataFrame(rows, "key string, listed boolean")
    cascade = urlfilter.build_cascade(universe)
    assert (len(cascade.levels) == 0) == (listed == 0)
    marked = urlfilter.with_listed(universe.withColumnRenamed("listed", "is"), "key", cascade)
    assert marked.where("is <> listed").count() == 0
    if listed >= 40 and others > 1000:
        assert len(cascade.levels) > 1


def test_large_lists_are_dealt_into_parts(spark):
    """Every part has a cascade of its own; the verdicts are those of one."""
    rows = [(n, f"http://host{n % 700}.net/{n}") for n in range(1500)] + [(-1, None), (-2, "http://host3.org/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string")

    def listed(host):
        return host.rlike("[05]\\.net$")

    whole = sorted(map(tuple, urlfilter.judge(pages, URL_RULES, listed, materialize).collect()), key=repr)
    universe = pages.selectExpr("url AS key", "true AS listed").where("key IS NOT NULL")
    assert urlfilter.cascade_parts(universe, 1000) == 4 and urlfilter.cascade_parts(universe) == 1
    parted = urlfilter.judge(pages, URL_RULES, listed, materialize, max_filter_bytes=100)
    assert sorted(map(tuple, parted.collect()), key=repr) == whole
    assert sum(r[4] == "block" for r in whole) > 200
