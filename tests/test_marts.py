"""The star schema on hand-made rows."""

import datetime as dt

from chanlytics import model
from chanlytics.plans.marts import Marts

D = dt.date


def _raw(spark, rows):
    full = []
    for r in rows:
        base = dict(message_id=1, channel_name="Chemed", channel_username="@CheMed123",
                    scrape_date=D(2024, 1, 5), message_date=D(2024, 1, 1), message_text="x",
                    message_length=1, views=0, forwards=0, has_photo=False, photo_path=None)
        base.update(r)
        full.append(tuple(base[f.name] for f in model.RAW_MESSAGES_SCHEMA.fields))
    return spark.createDataFrame(full, model.RAW_MESSAGES_SCHEMA)


def test_dim_channels_latest_name(spark):
    raw = _raw(spark, [
        dict(message_id=1, channel_name="Old", scrape_date=D(2024, 1, 1)),
        dict(message_id=2, channel_name="New", scrape_date=D(2024, 1, 2)),
        dict(message_id=3, channel_name="Tie-low", channel_username="@b", scrape_date=D(2024, 1, 2)),
        dict(message_id=4, channel_name="Tie-high", channel_username="@b", scrape_date=D(2024, 1, 2)),
        dict(message_id=5, channel_name="Dated", channel_username="@c", scrape_date=D(2024, 1, 9)),
        dict(message_id=6, channel_name="Undated", channel_username="@c", scrape_date=None),
    ])
    got = {r.channel_username: r.channel_name for r in Marts(raw).dim_channels.collect()}
    assert got == {"@CheMed123": "New", "@b": "Tie-high", "@c": "Undated"}


def test_fct_messages_keys_and_flags(spark):
    raw = _raw(spark, [
        dict(message_id=1, message_text="Urgent!", message_date=D(2024, 1, 1), scrape_date=D(2024, 1, 3)),
        dict(message_id=2, message_text=None, message_date=D(2024, 1, 9), scrape_date=D(2024, 1, 3)),
        dict(message_id=3, message_text="new VACANCY", message_date=D(2024, 1, 2), scrape_date=D(2024, 1, 3)),
    ])
    m = Marts(raw)
    rows = {r.message_id: r for r in m.fct_messages.collect()}
    assert rows[1].message_date_sk == 20240101 and rows[1].is_urgent_message
    assert rows[2].message_date_sk is None                 # after the last scrape date
    assert rows[2].scrape_date_sk == 20240103              # computed without the join
    assert (rows[2].is_urgent_message, rows[2].is_vacancy_message) == (False, False)
    assert rows[3].is_vacancy_message
    assert m.dim_dates.count() == 3


def test_fct_image_detections_unmatched(spark):
    raw = _raw(spark, [dict(message_id=1)])
    det = spark.createDataFrame(
        [("a_1_cat_0", 1, "@CheMed123", "p", "cat", None, None),
         ("a_9_cat_0", 9, "@CheMed123", "p", "cat", None, None)], model.RAW_DETECTIONS_SCHEMA)
    rows = {r.image_detection_sk: r.message_sk for r in Marts(raw, det).fct_image_detections.collect()}
    assert sorted(v is None for v in rows.values()) == [False, True]
