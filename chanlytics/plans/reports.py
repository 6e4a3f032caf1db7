"""The five report queries; B1-B6: the declared business questions.

Every report returns a DataFrame with fixed columns.  Reports with a
LIMIT give it a total order (ties broken on a key) so the result is
deterministic; the ordered limit is planned as ``TakeOrderedAndProject``
(a top-k per task, then a merge of k rows per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlytics import model
from chanlytics.functions.keys import surrogate_key
from chanlytics.functions.text import like_ci
from chanlytics.operators.keywords import dictionary, first_words, keyword_hits, mentions
from chanlytics.operators.quantile import lower_medians
from chanlytics.operators.search_index import prune


def top_products(fct_messages: DataFrame, keywords: "DataFrame | list[str] | None" = None,
                 limit: int = model.TOP_PRODUCTS_DEFAULT_LIMIT) -> DataFrame:
    """Most-mentioned keywords, ``(product_name, mention_count)``.

    Ties are broken by product_name (the reference breaks them by first
    appearance in an unordered scan).
    """
    if not 1 <= limit <= model.TOP_PRODUCTS_MAX_LIMIT:
        raise ValueError(f"limit must be in 1..{model.TOP_PRODUCTS_MAX_LIMIT}")
    keywords = model.DEFAULT_KEYWORDS if keywords is None else keywords
    counts = keyword_hits(fct_messages.select("message_text"), keywords)
    return counts.orderBy(F.desc("mention_count"), F.asc("product_name")).limit(limit)


def channel_activity(fct_messages: DataFrame, dim_channels: DataFrame,
                     dim_dates: DataFrame, channel_username: str) -> DataFrame:
    """R2: messages per day of one channel, ``(activity_date, message_count)``.

    Inner joins, as in the reference: days without posts are absent and
    messages without a date key drop out.  ``channel_sk`` of a username is
    its surrogate key by construction of dim_channels, so the same filter
    is also put on the fact, where it reaches the parquet scan.

    The dimensions are stored tables (or cached ones in the lazy model), so
    Spark knows their size and broadcasts them under its own threshold.
    """
    dc = dim_channels.filter(F.col("channel_username") == F.lit(channel_username)) \
        .select("channel_sk")
    dd = dim_dates.select("date_sk", "full_date")
    fm = fct_messages.filter(F.col("channel_sk") == surrogate_key(F.lit(channel_username))) \
        .select("channel_sk", "message_date_sk", "message_sk")
    joined = (fm.join(dc, "channel_sk")
              .join(dd, F.col("message_date_sk") == F.col("date_sk")))
    return (joined.groupBy(F.col("full_date").alias("activity_date"))
            .agg(F.count("message_sk").alias("message_count"))
            .orderBy("activity_date"))


def search_messages(fct_messages: DataFrame, query: str, literal: bool = False,
                    limit: int = model.REPORT_ROW_LIMIT, postings: DataFrame | None = None) -> DataFrame:
    """Messages whose lower-cased text is LIKE ``%query%``, latest 100.

    Order: message_date_sk DESC with NULL first (the reference's database
    order), then message_sk.  With the trigram postings of a stored fact
    (``operators.search_index``) only the files that may hold the query are read.
    """
    if query is None or len(query) < model.SEARCH_MIN_QUERY_LENGTH:
        raise ValueError(f"query must have at least {model.SEARCH_MIN_QUERY_LENGTH} characters")
    if postings is not None:
        fct_messages = prune(fct_messages, postings, query, literal)
    hits = fct_messages.filter(like_ci("message_text", query, literal))
    return (hits.select(*model.FCT_MESSAGES_COLUMNS)
            .orderBy(F.col("message_date_sk").desc_nulls_first(), F.col("message_sk"))
            .limit(limit))


def list_channels(dim_channels: DataFrame, collation: str | None = None) -> DataFrame:
    """All channels by name, then username.

    Names sort by binary order (A, B, a, b) unless a collation is given,
    e.g. ``"UNICODE"`` (a, A, b, B) or ``"UNICODE_CI"``, closer to a
    database's locale order.
    """
    name = F.col("channel_name") if collation is None else F.collate("channel_name", collation)
    return (dim_channels.select("channel_sk", "channel_username", "channel_name")
            .orderBy(name, "channel_username"))


def image_detections(fct_image_detections: DataFrame, message_sk: str | None = None,
                     limit: int = model.REPORT_ROW_LIMIT) -> DataFrame:
    """Up to 100 detections, optionally of one message.

    An empty message_sk means no filter, as in the reference; the rows
    are the first 100 by image_detection_sk.
    """
    df = fct_image_detections
    if message_sk:
        df = df.filter(F.col("message_sk") == F.lit(message_sk))
    return (df.select(*model.IMAGE_DETECTION_REPORT_COLUMNS)
            .orderBy("image_detection_sk").limit(limit))


# ---------------------------------------------------------------------------
# Declared business questions (semantics are ours)
# ---------------------------------------------------------------------------

def daily_volume(fct_messages: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """B1: messages per day over all channels, ``(activity_date, message_count)``.

    Pre-aggregated on the integer date key first (partial aggregate per
    task), then the few day rows meet the date dimension.
    """
    per_key = fct_messages.groupBy("message_date_sk").agg(F.count("message_sk").alias("message_count"))
    dd = dim_dates.select("date_sk", F.col("full_date").alias("activity_date"))
    return (per_key.join(dd, F.col("message_date_sk") == F.col("date_sk"))
            .select("activity_date", "message_count").orderBy("activity_date"))


def weekly_keyword_volume(fct_messages: DataFrame, dim_dates: DataFrame,
                          keywords: "DataFrame | list[str] | None" = None) -> DataFrame:
    """B2: weekly count of messages with at least one keyword hit.

    A test within each message, then one count per day; the few day rows meet
    the calendar.  Weeks start on Monday (``date_trunc('week')``); grouping
    by (year, week_of_year) would split ISO weeks at a year end.
    """
    keywords = model.DEFAULT_KEYWORDS if keywords is None else keywords
    hits = mentions(fct_messages.select("message_sk", "message_date_sk", "message_text"), keywords,
                    key="message_sk", group_cols=["message_date_sk"])
    per_key = hits.groupBy("message_date_sk").agg(F.count_if("mentioned").alias("n")).where("n > 0")
    dd = dim_dates.select("date_sk", "full_date")
    week = F.to_date(F.date_trunc("week", F.col("full_date")))
    return (per_key.join(dd, F.col("message_date_sk") == F.col("date_sk"))
            .groupBy(week.alias("week_start"))
            .agg(F.sum("n").alias("message_count"))
            .orderBy("week_start"))


def visual_share(fct_messages: DataFrame, dim_channels: DataFrame) -> DataFrame:
    """Photo messages per channel: total, with photo, per-mille share."""
    per = (fct_messages.groupBy("channel_sk")
           .agg(F.count(F.lit(1)).alias("message_count"),
                F.sum(F.when(F.col("has_photo"), 1).otherwise(0)).cast("long").alias("photo_count")))
    dc = dim_channels.select("channel_sk", "channel_username")
    return (per.join(dc, "channel_sk", "left")
            .select("channel_username", "message_count", "photo_count",
                    F.floor(F.col("photo_count") * 1000 / F.col("message_count"))
                    .cast("long").alias("photo_per_mille")))


def object_mix(fct_image_detections: DataFrame, fct_messages: DataFrame) -> DataFrame:
    """Detections per channel and object class.

    Detections are pre-aggregated per (message_sk, class) before they meet
    the message fact, so the join carries one row per message and class,
    and of the message fact its two keys.
    """
    per_msg = (fct_image_detections.filter(F.col("message_sk").isNotNull())
               .groupBy("message_sk", "detected_object_class")
               .agg(F.sum("detection_count").cast("long").alias("n")))
    return (per_msg.join(fct_messages.select("message_sk", "channel_username"), "message_sk")
            .groupBy("channel_username", "detected_object_class")
            .agg(F.sum("n").alias("detection_count")))


def product_by_channel(fct_messages: DataFrame,
                       keywords: "DataFrame | list[str] | None" = None) -> DataFrame:
    """Keyword mentions per channel, ``(channel_username, product_name, mention_count)``."""
    keywords = model.DEFAULT_KEYWORDS if keywords is None else keywords
    return keyword_hits(fct_messages.select("channel_username", "message_text"), keywords,
                        group_cols=["channel_username"])


# Fixed values of B6.  A text is read as blank-separated words; a word counts
# without the characters at its ends that are no letters, digits or
# underscores.  A mention is the keyword's words in a row; its price is the
# first of the next four words that is an amount: digits with thousands
# groups (1,500) or plain, and one or two decimals after '.' (or, without
# groups, ',').  An amount ends where its word ends, so no number is cut.
PRICE_REACH = 4
_TRIM = r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$"
_AMOUNT = r"^(\d{1,3}(,\d{3})+(\.\d{1,2})?|\d+([.,]\d{1,2})?)$"


def price_mentions(fct_messages: DataFrame, keywords: "DataFrame | list[str]",
                   keyword_col: str = "keyword") -> DataFrame:
    """(channel_username, product_name, price) of every priced mention.

    A keyword's first word is looked up within the text (a long dictionary
    is only joined), and of these places those with an amount within reach
    leave it, each with the words that follow it.
    """
    kw = dictionary([k.lower() for k in dict.fromkeys(keywords)] if isinstance(keywords, list) else
                    keywords.select(F.lower(keyword_col).alias(keyword_col)), keyword_col, fct_messages)
    # the longest keyword bounds what a word carries along: one small job over the dictionary
    longest = kw.agg(F.max(F.size("parts"))).first()[0] or 1
    word = lambda w: F.regexp_replace(w, _TRIM, "")
    texts = fct_messages.where("message_text is not null").select("channel_username", F.transform(
        F.array_remove(F.split(F.lower("message_text"), r"[ \t\r\n]+"), ""), word).alias("w"))
    reach = longest + PRICE_REACH
    amount = lambda x: F.rlike(x, F.lit(_AMOUNT))
    starts = first_words(kw)
    places = F.filter(F.transform("w", lambda x, i: F.when(starts(x), i)), lambda i: i.isNotNull())
    # w is used twice, and so stays a column of its own
    found = texts.select("channel_username", "w", places.alias("at"))
    near = F.transform("at", lambda i: F.struct(F.get("w", i).alias("first"), F.slice("w", i + 1, reach).alias("next")))
    places = F.filter(near, lambda s: F.exists(F.slice(s["next"], 2, reach), amount))
    here = found.select("channel_username", F.explode_outer(places).alias("s")).where("s is not null").select(
        "channel_username", F.col("s.first").alias("first"), F.col("s.next").alias("next"))
    n = F.size("parts")
    text = F.get(F.filter(F.slice("next", n + 1, F.lit(PRICE_REACH)), amount), 0)
    plain = F.when(text.rlike(r"^\d+,\d{1,2}$"), F.replace(text, F.lit(","), F.lit("."))).otherwise(
        F.replace(text, F.lit(","), F.lit("")))
    return (here.join(kw.where(n > 0).withColumn("first", F.get("parts", 0)), "first")
            .where(F.slice("next", 1, n) == F.col("parts"))
            .select("channel_username", "product_name", plain.try_cast("decimal(18,2)").alias("price"))
            .where("price is not null"))


def price_variation(fct_messages: DataFrame, keywords: "DataFrame | list[str] | None" = None) -> DataFrame:
    """(channel_username, product_name, n_prices, min/median/max price).

    The median is the lower middle value, exact: mentions are counted per
    (channel, product, price) first, and the middle is found among these
    counts, dealt by ranges of prices (``lower_medians``).
    """
    keywords = model.DEFAULT_KEYWORDS if keywords is None else keywords
    group = ["channel_username", "product_name"]
    counts = price_mentions(fct_messages, keywords).groupBy(*group, "price").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    totals = counts.groupBy(*group).agg(F.sum("n").alias("n_prices"), F.min("price").alias("min_price"),
                                        F.max("price").alias("max_price"))
    middle = lower_medians(counts, group, "price").withColumnsRenamed({c: f"__{c}" for c in group})
    same = F.col("channel_username").eqNullSafe(F.col("__channel_username")) & (F.col("product_name") == F.col("__product_name"))
    return totals.join(middle, same).select(*group, "n_prices", "min_price", F.col("median").alias("median_price"), "max_price")
