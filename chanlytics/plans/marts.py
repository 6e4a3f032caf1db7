"""M2-M5: dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlytics import model
from chanlytics.functions.dates import date_attributes
from chanlytics.functions.keys import date_key, surrogate_key
from chanlytics.functions.text import contains_ci

DIM_DATES_COLUMNS = [
    "date_sk", "full_date", "year", "month", "month_name", "day_of_month",
    "day_of_week_num", "day_of_week_name", "quarter", "week_of_year",
    "day_of_year", "is_weekend", "incremental_num",
]


def build_dim_channels(staging: DataFrame) -> DataFrame:
    """One row per channel_username, named as on its latest scrape.

    Latest = greatest scrape_date with NULL ranked first (the reference's
    ``ORDER BY scrape_date DESC``), ties broken by the greatest message_id,
    which is unique inside a username.  The messages meet a hash aggregate
    on numbers first (the greatest id for each name and date), so nothing is
    sorted and a channel holding a third of all messages costs a row per
    date and task; the pick by name works on that small result.
    """
    per_day = staging.groupBy("channel_username", "channel_name", "scrape_date").agg(
        F.max("message_id").alias("message_id"))
    order = F.struct(F.col("scrape_date").isNull(), F.col("scrape_date"), F.col("message_id"))
    latest = per_day.groupBy("channel_username").agg(
        F.max_by("channel_name", order).alias("channel_name"))
    return latest.select(
        surrogate_key("channel_username").alias("channel_sk"),
        "channel_username",
        "channel_name",
    )


def date_spine(lo: "F.Column", hi: "F.Column", bounds: DataFrame) -> DataFrame:
    """One row per day from lo to hi of a single-row frame (G1).

    The reference's database yields no rows when lo > hi or a bound is NULL, whereas
    Spark's ``sequence`` throws on reversed bounds, hence the guard.
    """
    return (bounds.filter(lo.isNotNull() & hi.isNotNull() & (lo <= hi))
            .select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("full_date"),
                    lo.alias("__lo")))


def build_dim_dates(staging: DataFrame) -> DataFrame:
    """Dense calendar from min(message_date) to max(scrape_date) (M3).

    The bounds are a global aggregate (partial per task, one final row).
    ``incremental_num`` is the day's position in the dense spine, i.e.
    ``row_number() OVER (ORDER BY full_date)`` computed as a date
    difference, so no single-partition window is needed.
    """
    bounds = staging.agg(F.min("message_date").alias("lo"), F.max("scrape_date").alias("hi"))
    return dim_dates_between(bounds, F.col("lo"), F.col("hi"))


def dim_dates_between(bounds: DataFrame, lo, hi) -> DataFrame:
    spine = date_spine(lo, hi, bounds)
    return spine.select(
        *date_attributes("full_date"),
        (F.datediff("full_date", "__lo") + 1).cast("int").alias("incremental_num"),
    )


def with_date_key(staging: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """Staged messages with message_date_sk, NULL for a date that the calendar does not have."""
    dd = F.broadcast(dim_dates.select(F.col("full_date").alias("__d"), F.col("date_sk").alias("message_date_sk")))
    return staging.join(dd, F.col("message_date") == F.col("__d"), "left").drop("__d")


def build_fct_messages(staging: DataFrame, dim_channels: DataFrame,
                       dim_dates: DataFrame) -> DataFrame:
    """Message fact with keys to both dimensions (M4).

    The calendar has one row a day, a fixed bound whatever the data, and is
    broadcast; channels join as Spark sees fit from their size.
    """
    dc = dim_channels.select("channel_username", "channel_sk")
    joined = with_date_key(staging.join(dc, "channel_username", "left"), dim_dates)
    flags = [contains_ci("message_text", needle).alias(name)
             for name, needle in model.MESSAGE_FLAGS.items()]
    return joined.select(
        "message_sk", "message_id", "channel_sk", "channel_username",
        "message_date_sk",
        date_key("scrape_date").alias("scrape_date_sk"),
        "message_text", "message_length", "views", "forwards", "has_photo", "photo_path",
        *flags,
        F.lit(1).alias("message_count"),
    )


def build_fct_image_detections(raw_detections: DataFrame, fct_messages: DataFrame) -> DataFrame:
    """Detection fact: raw detections ⟕ message fact on (message_id, channel_username) (M5).

    The one join of two fact-sized inputs: both shuffle on the composite
    key, high-cardinality through message_id (of the messages, three
    columns), unless Spark finds one side small enough to broadcast.
    """
    fm = fct_messages.select("message_id", "channel_username", "message_sk")
    joined = raw_detections.join(fm, ["message_id", "channel_username"], "left")
    return joined.select(
        surrogate_key("detection_id", "detected_object_class").alias("image_detection_sk"),
        "message_sk", "detected_object_class", "confidence_score", "image_path",
        "detection_timestamp",
        F.lit(1).alias("detection_count"),
    )


class Marts:
    """The staged model as plans over a raw messages/detections pair.

    Used where the marts are not stored (ad-hoc runs, the registered
    queries); the daily job stores every mart as a table instead
    (``plans.daily``).  Nothing is cached or kept between calls.
    """

    def __init__(self, raw_messages: DataFrame, raw_detections=None):
        """``raw_detections`` may be a DataFrame or a no-argument callable (built on first use)."""
        from chanlytics.plans.staging import stage_messages

        self.raw_messages = raw_messages
        self._raw_det = raw_detections
        self.staging = stage_messages(raw_messages)
        self._dc = self._dd = self._fm = self._fd = None

    @property
    def raw_detections(self) -> DataFrame | None:
        if callable(self._raw_det):
            self._raw_det = self._raw_det()
        return self._raw_det

    @property
    def dim_channels(self) -> DataFrame:
        if self._dc is None:
            self._dc = build_dim_channels(self.staging)
        return self._dc

    @property
    def dim_dates(self) -> DataFrame:
        if self._dd is None:
            self._dd = build_dim_dates(self.staging)
        return self._dd

    @property
    def fct_messages(self) -> DataFrame:
        if self._fm is None:
            self._fm = build_fct_messages(self.staging, self.dim_channels, self.dim_dates)
        return self._fm

    @property
    def fct_image_detections(self) -> DataFrame:
        if self._fd is None:
            if self.raw_detections is None:
                raise ValueError("no raw detections given")
            self._fd = build_fct_image_detections(self.raw_detections, self.fct_messages)
        return self._fd
