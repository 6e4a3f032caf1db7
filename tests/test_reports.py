"""R1-R5 and the keyword counting rule against an independent replay."""

import re
from collections import Counter

import pytest

from chanlytics import model
from chanlytics.plans import reports as R

COLS = ", ".join(f"{c} {t}" for c, t in [
    ("message_sk", "string"), ("message_id", "bigint"), ("channel_sk", "string"),
    ("channel_username", "string"), ("message_date_sk", "int"), ("scrape_date_sk", "int"),
    ("message_text", "string"), ("message_length", "int"), ("views", "int"), ("forwards", "int"),
    ("has_photo", "boolean"), ("photo_path", "string"), ("is_urgent_message", "boolean"),
    ("is_vacancy_message", "boolean"), ("message_count", "int")])


def _fct(spark, texts, dates=None):
    dates = dates or [20240101 + i for i in range(len(texts))]
    rows = [(f"sk{i:04d}", i, "c", "@c", d, d, t, 0, 0, 0, False, None, False, False, 1)
            for i, (t, d) in enumerate(zip(texts, dates))]
    return spark.createDataFrame(rows, COLS)


def replay_counts(texts, keywords):
    """The counting rule written out plainly in Python (ground truth)."""
    counts = Counter()
    for t in texts:
        if t is None:
            continue
        low = t.lower()
        words = re.findall(r"\w+", low)
        multi = [k for k in keywords if len(k.split()) > 1 and k in low]
        for w in words:
            if w in keywords:
                counts[w] += 1
            for k in multi:
                counts[k] += 1
    return counts


CASES = ["Tablet, tablet", "tablets", "test kit now", "test kits", None,
         "ፓራሲታሞል tablet ሽሮፕ", "Blood pressure monitor and gel gel", "insulin-syrup"]


def test_top_products_matches_replay(spark):
    got = {r.product_name: r.mention_count
           for r in R.top_products(_fct(spark, CASES), limit=100).collect()}
    assert got == dict(replay_counts(CASES, model.DEFAULT_KEYWORDS))
    assert got["tablet"] == 3 and got["test kit"] == 5 and "tablets" not in got


def test_top_products_ties_and_limit(spark):
    fct = _fct(spark, ["gel mask", "mask gel", "pill"])
    rows = [(r.product_name, r.mention_count) for r in R.top_products(fct, limit=2).collect()]
    assert rows == [("gel", 2), ("mask", 2)]
    with pytest.raises(ValueError):
        R.top_products(fct, limit=0)
    with pytest.raises(ValueError):
        R.top_products(fct, limit=101)


def test_search(spark):
    texts = [f"price {i}% off" for i in range(120)] + ["nothing here", None]
    fct = _fct(spark, texts)
    hits = R.search_messages(fct, "% OFF").collect()
    assert len(hits) == 100
    assert hits[0].message_date_sk == max(r.message_date_sk for r in hits)
    assert R.search_messages(fct, "pr_ce 1").count() == 31  # wildcard: 1, 10-19, 100-119
    with pytest.raises(ValueError):
        R.search_messages(fct, "x")


def test_list_channels_and_detections(spark):
    dc = spark.createDataFrame([("s2", "@b", "beta"), ("s1", "@a", "Alpha"), ("s3", "@c", "alpha")],
                               "channel_sk string, channel_username string, channel_name string")
    assert [r.channel_name for r in R.list_channels(dc).collect()] == ["Alpha", "alpha", "beta"]
    dc2 = spark.createDataFrame([("s1", "@a", "b"), ("s2", "@b", "B"), ("s3", "@c", "a")],
                                "channel_sk string, channel_username string, channel_name string")
    assert [r.channel_name for r in R.list_channels(dc2).collect()] == ["B", "a", "b"]
    assert [r.channel_name for r in R.list_channels(dc2, "UNICODE").collect()] == ["a", "b", "B"]
    det = spark.createDataFrame([(f"d{i:03d}", "m1" if i % 2 else "m2", "cat", None, "p", None, 1)
                                 for i in range(150)],
                                "image_detection_sk string, message_sk string, detected_object_class string, "
                                "confidence_score decimal(5,4), image_path string, "
                                "detection_timestamp timestamp_ntz, detection_count int")
    assert R.image_detections(det, "").count() == 100       # empty id: no filter
    assert R.image_detections(det, "m1").count() == 75
    assert R.image_detections(det).first().image_detection_sk == "d000"


def test_price_variation(spark):
    fct = _fct(spark, ["insulin 250 birr today", "insulin now only 300,50", "insulin pens 1 2 3 400",
                       "insulins 5", "no price insulin"])
    r = R.price_variation(fct, ["insulin"]).first()
    assert (r.n_prices, str(r.min_price), str(r.median_price), str(r.max_price)) == (3, "1.00", "250.00", "300.50")


def test_prices_are_whole_numbers(spark):
    """Thousands groups, no cut numbers, the nearest amount, keywords of several words."""
    texts = ["gel 1,500", "gel: 1,234,567.5!", "gel 3.141 then 7", "gel v1.2.3 and 20 or 30", "gel a b c d 9",
             "gel 1234567890123", "(gel) (12.50)", "gel 12345678901234567890", "blood gel mask 40", "gel mask 50",
             "gel 5 gel 6", "gel", None]
    got = sorted((r.product_name, str(r.price)) for r in R.price_mentions(_fct(spark, texts), ["gel", "Gel mask", "gel"]).collect())
    assert got == sorted([("gel", p) for p in ("1500.00", "1234567.50", "7.00", "20.00", "1234567890123.00", "12.50",
                                               "40.00", "50.00", "5.00", "6.00")]
                         + [("gel mask", "40.00"), ("gel mask", "50.00")])
    table = spark.createDataFrame([("GEL",), ("gel mask",), ("gel",)], "keyword string")
    rows = {r.product_name: r for r in R.price_variation(_fct(spark, texts), table).collect()}
    assert (rows["gel"].n_prices, str(rows["gel"].median_price)) == (10, "20.00")
    assert str(rows["gel mask"].median_price) == "40.00"


def test_search_takes_backslashes_as_the_database_does(spark):
    texts = ["C:\\dir d", "c:dir", "50% off", "50 off", "a_b", "axb", "back\\slash", "ends with %"]
    fct = _fct(spark, texts)

    def hits(query):
        return sorted(texts[r.message_id] for r in R.search_messages(fct, query).collect())
    assert hits("c:\\dir") == ["c:dir"]            # a backslash before a plain letter
    assert hits("c:\\\\dir") == ["C:\\dir d"]
    assert hits("50\\%") == ["50% off"] and hits("a\\_b") == ["a_b"]
    assert hits("with \\") == ["ends with %"]        # at the end it takes the closing wildcard


@pytest.mark.parametrize("as_table,literal", [(False, None), (True, None), (True, 0)])
def test_a_dictionary_of_words_and_phrases_matches_replay(spark, as_table, literal):
    """As a list, as a table, and as a table too long for a literal of the plan."""
    from chanlytics.operators import keywords as K

    texts = CASES + ["the test kit and blood pressure monitor", "contest kit", "a b c d", "test  kit", "ab cd ef", "", "kit test",
                     "test\u00a0kit", "the best\tkit", "x" * 9 + " yyyyy z", "n b c dd", "  lead kit  ", "\n a b"]
    kws = model.DEFAULT_KEYWORDS + ["a b", "b c d", "c", "b cd", "\ttablet", "test\u00a0kit", "best\tk", "xxxxx yyy", "", " ",
                                    "st k", "t kit", "tablet", "test kit", " lead k", "kit  ", "\n a b"]
    want = dict(replay_counts(texts + texts[:9], list(dict.fromkeys(kws))))
    given = spark.createDataFrame([(k,) for k in kws] + [(None,)], "keyword string") if as_table else kws
    bound = {} if literal is None else {"literal_chars": literal}
    fct = _fct(spark, texts + texts[:9])
    assert {r.product_name: r.mention_count for r in K.keyword_hits(fct, given, **bound).collect()} == want
    some = [t for t in texts + texts[:9] if t is not None and replay_counts([t], list(dict.fromkeys(kws)))]
    assert K.mentions(fct, given, key="message_sk", group_cols=["message_id"], **bound).where("mentioned").count() == len(some)


@pytest.mark.parametrize("size", [5, 100, 20_000])
@pytest.mark.parametrize("literal", [1 << 20, 0])
def test_dictionaries_of_each_size_match_replay(spark, size, literal):
    from chanlytics.operators import keywords as K

    texts = [f"w{i} w{i + 1} tail{i % 7}" for i in range(300)]
    kws = [f"w{i}" for i in range(0, size, 3)] + [f"w{i} w{i + 1}" for i in range(0, size, 2)] + ["tail1 no", "il6"]
    table = spark.createDataFrame([(k,) for k in kws], "keyword string")
    got = {r.product_name: r.mention_count for r in K.keyword_hits(_fct(spark, texts), table, literal_chars=literal).collect()}
    assert got == dict(replay_counts(texts, set(kws))) if size < 1000 else len(got) > 200
    if size > 1000:
        want = {}
        for t in texts:
            words = t.split()
            for w in words[:2]:
                if int(w[1:]) % 3 == 0:
                    want[w] = want.get(w, 0) + 1
            for i in range(0, 302, 2):
                if f"w{i} w{i + 1}" in t:
                    want[f"w{i} w{i + 1}"] = want.get(f"w{i} w{i + 1}", 0) + 3
        assert got == want


def test_phrases_by_automaton_and_by_gap(spark):
    """The same phrases, with the automaton's package and without."""
    from chanlytics.operators import keywords as K
    from pyspark.sql import functions as F

    texts = [t.lower() for t in CASES if t] + ["ab cd ef", "test  kit", "test\u00a0kit", "", "a b", "xa bx", " ab  cd", "one"]
    phrases = [f"w{i} x{i}" for i in range(60)] + ["ab cd", "b cd", "test kit", "a b", "t\u00a0k", "cd e", "ab  cd", "blood pressure monitor"]
    rows = spark.createDataFrame([(t,) for t in texts], "lt string")
    for automaton in (True, False):
        keyed, found = K._phrase_hits(rows, phrases, automaton)
        got = {r.lt: sorted(r.f) for r in keyed.select("lt", found.alias("f")).collect()}
        assert got == {t: sorted(p for p in phrases if p in t) for t in texts}, automaton


@pytest.mark.parametrize("pieces", [1, 3, 50])
def test_medians_of_groups_larger_than_a_piece(spark, pieces):
    import random

    from chanlytics.operators.quantile import lower_medians

    rng = random.Random(pieces)
    rows = [(g, v, rng.randrange(1, 9)) for g, many in (("a", 2000), ("b", 1), (None, 40), ("c", 2))
            for v in rng.sample(range(10_000), many)]
    df = spark.createDataFrame(rows, "g string, value long, n long").repartition(5)
    got = {r.g: r.median for r in lower_medians(df, ["g"], pieces=pieces).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        own = sorted(v for h, v, n in rows if h == g for _ in range(n))
        want[g] = own[(len(own) - 1) // 2]
    assert got == want
    assert lower_medians(df.where("false"), ["g"], pieces=pieces).collect() == []


def test_joined_phrases_of_every_shape(spark):
    """Random phrases, cut from texts at any place, are found as substrings are."""
    import random

    from chanlytics.operators import keywords as K

    r = random.Random(7)
    texts = ["".join(r.choice(["a", "b", "\u1234", "\U0001F600", " ", "  ", "\u00a0", "\n"]) for _ in range(r.randrange(60))) for _ in range(80)]
    texts += ["", " ", "x" * 3000 + " y", "a b"] + texts[:5]
    cut = [t[i:i + r.randrange(2, 12)] for t in texts for i in range(0, len(t), 3)]
    phrases = sorted({p for p in cut if len(p.split()) > 1} | {"a zz", "zz b", "x y", "b a "})
    assert len(phrases) > 200
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, lt string")
    kw = K.dictionary(spark.createDataFrame([(p,) for p in phrases], "keyword string"), "keyword", rows)
    got = {(x.i, x.product_name) for x in K._joined_phrases(rows, kw, ["i"]).collect()}
    assert got == {(i, p) for i, t in enumerate(texts) for p in phrases if p in t}
