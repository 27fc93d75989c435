"""URL rules and mined rules against brute force."""

import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from strataflow.llm.queries import QUERIES, URL_RULES
from strataflow.llm.urls import MIN_CONFIDENCE, MIN_SUPPORT, judge, mine, tokens

SF = "/root/testdata/sf0.01"


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def _rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def _mine(baskets):
    """All rules of any number of tokens, pruned the same way, by enumeration."""
    n = len(baskets)
    count, with_verdict = {}, {}
    for items, verdict in baskets:
        for size in range(1, len(items) + 1):
            for c in combinations(sorted(items), size):
                count[c] = count.get(c, 0) + 1
                with_verdict[c, verdict] = with_verdict.get((c, verdict), 0) + 1
    rules = {
        (c, v): k / count[c] for (c, v), k in with_verdict.items() if k / n >= MIN_SUPPORT and k / count[c] >= MIN_CONFIDENCE
    }
    return {
        (c, v): conf
        for (c, v), conf in rules.items()
        if not any(rules.get((p, v), -1) >= conf for size in range(1, len(c)) for p in combinations(c, size))
    }


def test_query_over_the_whole_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op10_url_rules"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    items = {
        r.page_id: r.items
        for r in spark.createDataFrame([(k, u, *_parts(u)) for k, u in pages.items()], "page_id long, url string, host string, path string")
        .select("page_id", tokens(F.col("url"), F.col("host"), F.col("path")).alias("items")).collect()
    }
    given = {k: _rule(*_parts(u)) for k, u in pages.items()}
    rules = _mine([(items[k], r.verdict) for k, r in given.items() if r])
    assert rules
    for r in got:
        assert (r.host, r.path) == _parts(pages[r.page_id])
        rule = given[r.page_id]
        assert r.rule == (rule.text if rule else None)
        if rule:
            assert r.verdict == rule.verdict
            continue
        held = [(-conf, c, v) for (c, v), conf in rules.items() if set(c) <= set(items[r.page_id])]
        if not held:
            assert (r.verdict, r.mined) == ("allow", None)
        else:
            assert r.confidence == pytest.approx(-min(held)[0])
            assert (tuple(r.mined), r.verdict) in rules


def test_mined_rules_equal_enumeration(spark):
    baskets = [(["a", "b", "c"], "block")] * 6 + [(["a", "d"], "allow")] * 5 + [(["b", "d"], "allow")] * 2 + [(["c"], "block")] * 3
    df = spark.createDataFrame(baskets, "items array<string>, verdict string")
    got = {(tuple(r.antecedent), r.verdict): r.confidence for r in mine(df).collect()}
    assert got == pytest.approx(_mine(baskets))


def test_a_rule_may_need_four_tokens(spark):
    four = ["a", "b", "c", "d"]
    baskets = [(four, "block")] * 40 + [([x for x in four if x != y], "allow") for y in four for _ in range(20)]
    df = spark.createDataFrame(baskets, "items array<string>, verdict string")
    got = {(tuple(r.antecedent), r.verdict): r.confidence for r in mine(df).collect()}
    assert got == pytest.approx(_mine(baskets))
    assert got[tuple(four), "block"] == 1.0


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, "nothing"), (None, "http://COM/"), (4, "http://Example.com/en/x?y#z"), (4, "http://Example.com/en/x?y#z"),
            (5, "http://www.example.com/en/"), (6, "x://net?es/"), (7, "x://é.NET/es/a://b"), (8, "http://" + "a" * 100_000 + ".com/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("token", F.lit("clash"))
    got = {(r.page_id, r.rule): r for r in judge(df, URL_RULES).collect()}
    assert {k[0] or 0: k[1] for k in got} == {
        0: "com/", 1: None, 2: None, 3: None, 4: "example.com/en/", 5: "www.example.com/en/", 6: None, 7: "net/es/", 8: "com/"
    }
    assert got[6, None].host == "net" and got[6, None].path == "" and got[7, "net/es/"].host == "é.net"
    assert judge(df, URL_RULES).count() == len(rows)
    assert judge(df.limit(0), URL_RULES).count() == 0
