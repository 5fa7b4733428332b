from __future__ import annotations

import math
import random
from collections import Counter

import pyspark.sql.functions as F
import pytest

from tierhouse.llm.queries import URL_RULES
from tierhouse.llm.url_filter import entropy, judge_urls

SCHEMA = "page_id long, url string"


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("#")[0].split("?")[0]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


def urls():
    rng = random.Random(3)
    hosts = ["example.com", "www.example.com", "a.www.Example.COM", "notexample.com", "x.net", "net", "com", "x.org", "ünï.net"]
    made = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randrange(99)}"
            f"{rng.choice(['', '?a=1&b=2', '#top', '.html'])}" for _ in range(400)]
    return [*made, None, "", "no scheme", "http://", "http://example.com", "http://example.com?x=/en/", "http://x.net/es",
            "a://b://c/d", "http://example.com/en/\nline", "HTTP://EXAMPLE.com/en/?q://z", "x" * 20000, "http://net/es/" + "y" * 9000]


def test_hosts_paths_and_rules(spark):
    rows = list(enumerate(urls()))
    found = judge_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path, rule = plain(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule[0] if rule else None), r.url
        assert r.verdict == rule[1] if rule else r.verdict in ("allow", "block")
    assert {r.verdict_by for r in found} == {"rule", "method"}


def test_trees_learn_what_the_labelled_urls_show(spark):
    rng = random.Random(4)
    good = [f"https://site{k}.com/news/{rng.randrange(9)}" for k in range(300)]
    bad = [f"http://x-{rng.randrange(10**9)}.bad/a/b/c/{rng.randrange(10**12)}?q=1&r=2&s=3" for _ in range(300)]
    asked = ["https://other.org/news/4", "http://y-183746512.org/a/b/c/918273645546?q=1&r=2&s=3"]
    rules = [("allow", "com", "/"), ("block", "bad", "/")]
    found = judge_urls(spark.createDataFrame(list(enumerate(good + bad + asked)), SCHEMA), rules).collect()
    assert [r.verdict for r in sorted(found, key=lambda r: r.page_id)[-2:]] == ["allow", "block"]


def test_one_verdict_none_and_empty(spark):
    docs = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.org/"), (2, "http://b.org/"), (None, None)], SCHEMA)
    def verdicts(rules):
        return sorted(r.verdict for r in judge_urls(docs, rules).collect())
    assert verdicts([("block", "com", "/")]) == ["block"] * 4
    assert verdicts([]) == ["allow"] * 4
    assert judge_urls(docs.limit(0), URL_RULES).collect() == []
    clash = docs.withColumns({c: F.lit("z") for c in ("host", "top", "features", "label", "found")})
    assert judge_urls(clash, [("block", "com", "/"), ("allow", "org", "/")]).columns == [
        *clash.columns, "path", "rule", "verdict_by", "verdict"
    ]


@pytest.mark.parametrize("text", ["", "a", "abab", "http://example.com/x?y", "é$^.*["])
def test_entropy(spark, text):
    told = spark.createDataFrame([(text,)], "t string").select(entropy(F.col("t"))).first()[0]
    assert told == pytest.approx(sum(-n / len(text) * math.log2(n / len(text)) for n in Counter(text).values()))


def test_a_url_of_many_rows_leaves_room_for_others(spark):
    rng = random.Random(4)
    good = [f"https://site{k}.com/news/{rng.randrange(9)}" for k in range(300)]
    bad = [f"http://x-{rng.randrange(10**9)}.bad/a/b/c/{rng.randrange(10**12)}?q=1&r=2&s=3" for _ in range(300)]
    asked = ["https://other.org/news/4", "http://y-183746512.org/a/b/c/918273645546?q=1&r=2&s=3"]
    hashed = spark.createDataFrame([(u,) for u in good + bad], "url string").orderBy(F.xxhash64("url"))
    hot = hashed.first().url
    rows = list(enumerate([hot] * 400 + good + bad + asked))
    rules = [("allow", "com", "/"), ("block", "bad", "/")]
    found = judge_urls(spark.createDataFrame(rows, SCHEMA), rules, train_rows=150).collect()
    assert len(found) == len(rows)
    assert [r.verdict for r in sorted(found, key=lambda r: r.page_id)[-2:]] == ["allow", "block"]
