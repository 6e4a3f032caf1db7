"""Q1-Q7: each kind of check fails on a fixture made to fail it."""

from chanlytics.operators.quality import Check, all_checks, run_checks


def test_each_kind_fails(spark):
    t = spark.createDataFrame([(1, "a"), (2, None), (2, "b"), (None, "c")], "id long, v string")
    parent = spark.createDataFrame([(1,), (3,)], "id long")
    checks = [Check("not_null", "t", "v"), Check("unique", "t", "id"),
              Check("relationships", "t", "id", "p", "id"),
              Check("expression", "t", "v", predicate="v = 'c'", name="custom:v_is_c")]
    got = {r.test_name: (r.failures, r.passed) for r in run_checks({"t": t, "p": parent}, checks).collect()}
    assert got == {"not_null:t.v": (1, False), "unique:t.id": (1, False),
                   "relationships:t.id->p.id": (2, False), "custom:v_is_c": (1, False)}


def test_keys_of_connected_columns(spark):
    """One column in several checks, a column without a parent row, other types, empty tables, no checks."""
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k int")
    b = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "k string")
    c = spark.createDataFrame([(3,), (9,), (9,)], "k long")
    checks = [Check("unique", "a", "k"), Check("unique", "b", "k"), Check("unique", "c", "k"),
              Check("relationships", "a", "k", "b", "k"), Check("relationships", "c", "k", "b", "k"),
              Check("relationships", "c", "k", "a", "k")]
    got = [r.failures for r in run_checks({"a": a, "b": b, "c": c}, checks).collect()]
    assert sorted(got) == sorted([1, 1, 1, 1, 2, 1])
    by = {r.test_name: r.failures for r in run_checks({"a": a, "b": b, "c": c}, checks).collect()}
    assert by["relationships:a.k->b.k"] == 1 and by["relationships:c.k->b.k"] == 2 and by["relationships:c.k->a.k"] == 1
    none = {n: df.where("false") for n, df in (("a", a), ("b", b), ("c", c))}
    assert [r.failures for r in run_checks(none, checks).collect()] == [0] * 6


def test_a_key_column_is_sent_once(spark):
    from chanlytics.operators.quality import _key_slots

    slots = _key_slots(all_checks())
    assert slots["stg_messages", "message_sk"][0] == slots["fct_image_detections", "message_sk"][0]
    assert slots["dim_dates", "date_sk"][0] != slots["dim_dates", "full_date"][0]
    assert len(set(slots.values())) == len(slots) == 12


def test_declared_suite_size():
    kinds = [c.kind for c in all_checks()]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("relationships")) == (32, 8, 5)
    assert len(kinds) == 48


def test_detection_health_and_confidence_range(spark):
    import datetime as dt
    from decimal import Decimal

    from chanlytics import model
    from chanlytics.operators.quality import CONFIDENCE_RANGE, detection_health

    ts = dt.datetime(2025, 7, 15)
    det = spark.createDataFrame([
        ("Chemed_11_clock_0", 11, "@CheMed123", "data/images/Chemed_11.jpg", "clock", Decimal("0.4273"), ts),
        ("Chemed_13_hot dog_0", 13, "@CheMed123", "data/images/Chemed_13.jpg", "hot dog", Decimal("0.5039"), ts),
        ("Chemed_13_hot dog_0", 13, "@CheMed123", "data/images/Chemed_13.jpg", "hot dog", Decimal("0.3097"), ts),
        ("Chemed_99_cup_0", 99, "@CheMed123", "data/images/Chemed_99.jpg", "cup", Decimal("1.2000"), ts),
    ], model.RAW_DETECTIONS_SCHEMA)
    msgs = spark.createDataFrame([(11, "@CheMed123"), (13, "@CheMed123")],
                                 "message_id long, channel_username string")
    h = detection_health(det, msgs)
    assert h["total"].first().total_detections == 4
    assert {(r.channel_username, r.detections) for r in h["by_channel"].collect()} == {("@CheMed123", 4)}
    assert [(r.detection_id, r.n) for r in h["duplicates"].collect()] == [("Chemed_13_hot dog_0", 2)]
    assert [r.detection_id for r in h["sample"].collect()][:2] == ["Chemed_11_clock_0", "Chemed_13_hot dog_0"]
    assert [(r.message_id, r.channel_username) for r in h["orphans"].collect()] == [(99, "@CheMed123")]
    fd = det.withColumnRenamed("detection_id", "image_detection_sk")
    got = run_checks({"fct_image_detections": fd}, [CONFIDENCE_RANGE]).first()
    assert (got.failures, got.passed) == (1, False)
