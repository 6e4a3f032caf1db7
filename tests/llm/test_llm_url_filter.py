"""URL verdicts against a plain test of every rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

from chanlytics.llm import common as C
from chanlytics.llm import url_filter as U

URLS = [None, "", "no scheme", "http://", "http://?q", "http://EXAMPLE.org/es/x", "https://a.b.Example.ORG/es", "http://example.org/es/",
        "http://example.org/en/1", "http://example.org/en/12?x#y", "http://notexample.org/es/1", "http://x.com/fr/1", "http://x.com/FR/1",
        "http://x.com/de/a/casino/", "http://casino.x.com/en", "http://CASINO.x.net/en", "http://mycasino.net/", "http://a.net/free-bets/",
        "http://a.net/Free_Bets", "http://a.net/wp-login.php", "http://a.net/adult-education/", "http://a.net/adult", "http://org/?a",
        "http://x.org#casino", "ftp://a://b/casino?", "http://x.org?p=/casino/", "http://é.org/x", "http://a.net/caféspam/\nspam\n",
        "http://u@x.org:80/casino", "://x.org/", "http://a.net/porn\n"]


def plain(url, sites=U.SITE_RULES, patterns=U.PATTERN_RULES, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    lower = str.maketrans(U._UPPER, U._LOWER)
    host = host.translate(lower)
    order = lambda r: (-len(r[0]), r[0])
    site = pattern = None
    for rule in sorted(sites, key=order):
        h, p = rule[0].split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            site = rule
            break
    text = (host + path).translate(lower)
    for rule in sorted(patterns, key=order):
        if re.search(U.expression(rule[0], False), text):
            pattern = rule
            break
    return host, path, site and site[0], (site or pattern or (None, default))[1], pattern and pattern[0]


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "c", "c", "c") for i, u in enumerate(urls)],
                                 "page_id long, url string, host string, rule string, target string")


def found(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict, r.pattern) for r in df.collect()}


@pytest.mark.parametrize("most", [U.BROADCAST_CHARS, 0])
def test_verdicts(spark, most):
    """Broadcast and joined index, clashing column names, null and odd URLs, repeated rows."""
    C.prepare(spark)
    df = frame(spark, URLS + URLS)
    got = found(U.judge(df, broadcast_chars=most))
    assert got == {i: plain(u) for i, u in enumerate(URLS + URLS)}
    assert {v[3] for v in got.values()} == {"allow", "block"} and any(v[4] for v in got.values())
    assert U.judge(df.where("false"), broadcast_chars=most).collect() == []
    none = U.judge(df, site_rules=[], pattern_rules=[], default="block", broadcast_chars=most).select("verdict").distinct()
    assert [r.verdict for r in none.collect()] == ["block"]


@pytest.mark.parametrize("most", [U.BROADCAST_CHARS, 0])
def test_random_rules(spark, most):
    C.prepare(spark)
    rng = random.Random(11)
    word = lambda: rng.choice(["ab", "c", "de1", "x", "Ab", "é"])
    patterns = []
    while len(patterns) < 60:
        rule = rng.choice(["", "|", "^", "/"]) + "".join(word() + rng.choice(["^", "*", "/", "-", "."]) for _ in range(rng.randrange(1, 4)))
        if U.rule_tokens(rule, False) and rule not in dict(patterns):
            patterns.append((rule, rng.choice(["allow", "block"])))
    sites = [("ab/", "block"), ("c.ab/x", "allow"), ("de1/ab/", "block")]
    urls = ["http://" + "".join(word() + rng.choice([".", "/", "-", "."]) for _ in range(rng.randrange(1, 7))) for _ in range(400)]
    got = found(U.judge(frame(spark, urls), site_rules=sites, pattern_rules=patterns, broadcast_chars=most))
    assert got == {i: plain(u, sites, patterns) for i, u in enumerate(urls)}


def test_index_holds_the_rarest_token(spark):
    C.prepare(spark)
    df = frame(spark, ["http://a.b/c"] * 3 + ["http://a.b/d"] * 2 + ["http://x.z/"])
    host, path = U.host_and_path(F.col("url"))
    urls = df.select(F.concat(host, path).alias("target"), F.lower(F.concat(host, path)).alias("lowered"))
    rules = U._rule_rows(spark, [("a.b/", "block"), ("b/d/", "block")], True).unionByName(
        U._rule_rows(spark, [("^a^c^", "block"), ("^zz^x^", "allow")], False))
    assert {r.rule: r.token for r in U.build_index(urls, rules).collect()} == {"a.b/": "a", "b/d/": "d", "^a^c^": "c", "^zz^x^": "zz"}


def test_rules_without_a_token_are_refused(spark):
    C.prepare(spark)
    assert U.rule_tokens("ab*", False) == [] and U.rule_tokens("|ab/", False) == ["ab"] and U.rule_tokens("example.org/en/1", True) == [
        "example", "org", "en"]
    with pytest.raises(Exception, match="without a whole literal token"):
        U.judge(frame(spark, URLS), pattern_rules=[("ab*", "block")]).collect()
