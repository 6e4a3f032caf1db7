"""D1 end to end on fixture exports: ingest -> marts -> checks -> reports."""

import datetime as dt
import json
import os

from chanlytics.plans import reports as R
from chanlytics.plans.daily import Layout, run_daily


def test_run_daily(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    day = dt.date(2025, 7, 15)
    os.makedirs(os.path.join(landing, day.isoformat()))
    rows = [
        {"message_id": 1, "channel": "Chemed", "date": "2025-07-13", "text": "Urgent: 2 tablet offers",
         "views": 5, "forwards": 0, "has_photo": True, "photo_path": "data/images/Chemed_1.jpg"},
        {"message_id": 2, "channel": "Chemed", "date": "2025-07-14", "text": "VACANCY test kit",
         "views": 5, "forwards": 0, "has_photo": False, "photo_path": None},
        {"message_id": 3, "channel": "TikvahPharma", "date": "2025-07-14", "text": None,
         "views": None, "forwards": None, "has_photo": True, "photo_path": None},
    ]
    with open(os.path.join(landing, day.isoformat(), "export.json"), "w") as f:
        json.dump(rows, f)
    layout = Layout(warehouse=os.path.join(tmp_dir, "wh"), landing=landing)
    res = run_daily(spark, layout, day)
    assert [(r.recorded, r.skipped) for r in res.accounting.collect()] == [(3, 0)]
    assert res.totals == {"rows": 3, "recorded": 3, "skipped": 0}
    checks = {r.test_name: r.failures for r in res.checks.collect()}
    assert len(checks) == 48
    # no detections were loaded: every detection check passes on an empty table
    assert checks["custom:has_photo_true_without_photo_path"] == 1
    assert checks["custom:has_photo_false_with_photo_path"] == 0
    assert all(v == 0 for k, v in checks.items() if k.startswith(("not_null", "unique", "relationships")))
    fm = spark.read.parquet(res.tables["fct_messages"])
    flags = {r.message_id: (r.is_urgent_message, r.is_vacancy_message) for r in fm.collect()}
    assert flags == {1: (True, False), 2: (False, True), 3: (False, False)}
    dd = spark.read.parquet(res.tables["dim_dates"])
    assert dd.count() == 3  # 2025-07-13 .. 2025-07-15
    act = R.channel_activity(fm, spark.read.parquet(res.tables["dim_channels"]), dd, "@CheMed123")
    assert [(str(r.activity_date), r.message_count) for r in act.collect()] == [
        ("2025-07-13", 1), ("2025-07-14", 1)]
    top = R.top_products(fm, limit=5)
    assert [(r.product_name, r.mention_count) for r in top.collect()] == [
        ("test kit", 3), ("tablet", 1)]


def test_run_daily_with_scoring(spark, tmp_dir):
    """D1 with the detector: images scored, detections linked, every check passes."""
    import numpy as np

    from tests.test_streaming import LengthScorer

    day = dt.date(2025, 7, 15)
    land = os.path.join(tmp_dir, "landing", day.isoformat())
    os.makedirs(land)
    with open(os.path.join(land, "Chemed.json"), "w") as f:
        json.dump([{"message_id": 1, "channel": "Chemed", "date": "2025-07-14", "text": "insulin 200",
                    "views": 1, "forwards": 0, "has_photo": True,
                    "photo_path": "data/images/Chemed_1.jpg"}], f)
    img = os.path.join(tmp_dir, "images")
    os.makedirs(img)
    with open(os.path.join(img, "Chemed_1.jpg"), "wb") as f:
        f.write(np.zeros(250, dtype=np.uint8).tobytes())
    layout = Layout(os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "landing"), images=img)
    res = run_daily(spark, layout, day, scorer=LengthScorer())
    fd = spark.read.parquet(res.tables["fct_image_detections"])
    assert [(r.detected_object_class, r.message_sk is not None) for r in fd.collect()] == [
        ("blob", True), ("blob", True)]
    assert res.checks.filter("failures > 0").count() == 0


def test_readers_see_complete_versions(spark, tmp_dir):
    """By name: the old tables until a run is published, then the new; a table is never missing or half written."""
    import threading

    from chanlytics import model
    from chanlytics.plans import daily as P

    landing = os.path.join(tmp_dir, "landing")

    def export(day, ids):
        os.makedirs(os.path.join(landing, day))
        rows = [{"message_id": i, "channel": "Chemed", "date": "2025-07-13", "text": f"gel {i}", "views": 1, "forwards": 0,
                 "has_photo": False, "photo_path": None} for i in ids]
        with open(os.path.join(landing, day, "Chemed.json"), "w") as f:
            json.dump(rows, f)

    layout = Layout(os.path.join(tmp_dir, "wh"), landing, database="versions")
    export("2025-07-14", range(4))
    export("2025-07-15", range(2, 9))
    run_daily(spark, layout, dt.date(2025, 7, 14))
    names = ("fct_messages", "dim_channels", "dim_dates", "report_top_products", "stg_messages")
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(tuple(spark.table(f"versions.{n}").count() for n in names[:4]))

    reader = threading.Thread(target=read)
    reader.start()
    res = run_daily(spark, layout, dt.date(2025, 7, 15))
    stop.set()
    reader.join()
    assert res.totals == {"rows": 7, "recorded": 5, "skipped": 2}
    assert {s[0] for s in seen} <= {4, 9} and seen[0][0] == 4 and {s[1] for s in seen} == {1} and {s[2] for s in seen} <= {2, 3}
    assert [spark.table(f"versions.{n}").count() for n in names] == [9, 1, 3, 1, 9]
    # the view's key is the model's
    own = {r.message_sk for r in spark.table("versions.stg_messages").collect()}
    assert own == {r.message_sk for r in spark.table("versions.fct_messages").collect()}
    # a catalog without the names finds the last published run in the warehouse
    spark.sql("DROP DATABASE versions CASCADE")
    P.create_tables(spark, layout)
    assert spark.table("versions.fct_messages").count() == 9
    run_daily(spark, layout, dt.date(2025, 7, 15))
    assert len(P.drop_old_versions(spark, layout, keep=2)) == 1 and spark.table("versions.fct_messages").count() == 9
    assert spark.table("versions.raw_messages").columns == model.RAW_MESSAGES_SCHEMA.names


def test_checks_and_reports_run_at_once(spark, tmp_dir, monkeypatch):
    """Each waits for the other to have begun; an error in one is raised, and nothing is published."""
    import threading

    import pytest

    from chanlytics.plans import daily as P

    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(os.path.join(landing, "2025-07-14"))
    with open(os.path.join(landing, "2025-07-14", "Chemed.json"), "w") as f:
        json.dump([{"message_id": 1, "channel": "Chemed", "date": "2025-07-13", "text": "gel", "views": 1,
                    "forwards": 0, "has_photo": False, "photo_path": None}], f)
    met = threading.Barrier(2, timeout=30)
    run_checks, write_reports = P.Q.run_checks, P.write_reports

    def failing(tables, layout, run):
        met.wait()
        raise KeyError("report")

    monkeypatch.setattr(P.Q, "run_checks", lambda tables: (met.wait(), run_checks(tables))[1])
    monkeypatch.setattr(P, "write_reports", lambda *args: (met.wait(), write_reports(*args))[1])
    layout = Layout(os.path.join(tmp_dir, "wh"), landing, database="at_once")
    spark.sparkContext.setLocalProperty("chanlytics.test", "caller")
    res = run_daily(spark, layout, dt.date(2025, 7, 14))
    assert res.checks.count() == 48 and set(res.reports) == set(P.REPORTS)
    assert P.side_by_side(spark, [lambda: spark.sparkContext.getLocalProperty("chanlytics.test")] * 2) == ["caller"] * 2
    spark.sparkContext.setLocalProperty("chanlytics.test", None)
    monkeypatch.setattr(P, "write_reports", failing)
    with pytest.raises(KeyError):
        run_daily(spark, layout, dt.date(2025, 7, 14))
    assert len(P._runs(spark, layout)) == 1


def test_search_postings_are_published_with_the_fact(spark, tmp_dir):
    from chanlytics.operators.search_index import candidate_files
    from chanlytics.plans import daily as P
    from chanlytics.plans import reports as R

    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(os.path.join(landing, "2025-07-14"))
    with open(os.path.join(landing, "2025-07-14", "Chemed.json"), "w") as f:
        json.dump([{"message_id": i, "channel": "Chemed", "date": "2025-07-13", "text": f"blood kit {i}", "views": 1,
                    "forwards": 0, "has_photo": False, "photo_path": None} for i in range(5)], f)
    layout = Layout(os.path.join(tmp_dir, "wh"), landing, database="searched", search_postings=True)
    run_daily(spark, layout, dt.date(2025, 7, 14))
    fct, postings = spark.table("searched.fct_messages"), spark.table("searched.fct_message_trigrams")
    assert [r.message_text for r in R.search_messages(fct, "kit 3", postings=postings).collect()] == ["blood kit 3"]
    assert candidate_files(fct, postings, "tablet") == [] and R.search_messages(fct, "tablet", postings=postings).count() == 0
    run_daily(spark, layout, dt.date(2025, 7, 14))
    assert len(P.drop_old_versions(spark, layout, keep=1)) == 1
    files = spark.table("searched.fct_messages").select("_metadata.file_name").distinct().count()
    assert spark.table("searched.fct_message_trigrams").where("trigram = 'blo'").count() == files
