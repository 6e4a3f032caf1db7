"""Registered queries: one per operator of the model, with its DuckDB twin.

Each query takes ``(spark, sf_dir)``, reads the driver tables in
``sf_dir`` and returns a DataFrame.  ``ORACLE`` holds the equivalent
DuckDB SQL over the same tables (views named like the parquet files).
Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlytics import oracle as O
from chanlytics.plans import marts as M
from chanlytics.plans import reports as R
from chanlytics.sources import driver_tables as D

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def model_for(spark: SparkSession, sf_dir: str) -> M.Marts:
    """The model over the driver tables, as plans."""
    return M.Marts(D.raw_messages(spark, sf_dir), lambda: D.raw_detections(spark, sf_dir))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint folder (the shared one on a cluster)."""
    import uuid

    from chanlytics.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Report arguments used by the registered queries (fixed values).
ACTIVITY_CHANNEL = "src3"
SEARCH_QUERY = "the"
PARITY_KEYWORDS = ["the", "la", "der", "of the", "in the", "und", "data", "tablet", "test kit"]


def _sql_list(words: list[str]) -> str:
    return ", ".join("('" + w.replace("'", "''") + "')" for w in words)


# --- model builds (M1-M5) ---------------------------------------------------

@register("m1_stage_messages", O.with_model("SELECT * FROM staging", "staging"))
def q_stage(spark, sf_dir):
    return model_for(spark, sf_dir).staging


@register("m2_dim_channels", O.with_model("SELECT * FROM dim_channels", "dim_channels"))
def q_dim_channels(spark, sf_dir):
    return model_for(spark, sf_dir).dim_channels


@register("m3_dim_dates", O.with_model("SELECT * FROM dim_dates", "dim_dates"))
def q_dim_dates(spark, sf_dir):
    return model_for(spark, sf_dir).dim_dates


@register("m3_dim_dates_long_range",
          "WITH " + O.dim_dates_sql(
              "spine", "SELECT CAST(min(o_orderdate) AS DATE) AS lo, "
                       "CAST(max(o_orderdate) AS DATE) AS hi FROM orders").strip()
          + "\nSELECT * FROM spine")
def q_dim_dates_orders(spark, sf_dir):
    o = D.table(spark, sf_dir, "orders")
    bounds = o.agg(F.min(F.to_date("o_orderdate")).alias("lo"),
                   F.max(F.to_date("o_orderdate")).alias("hi"))
    return M.dim_dates_between(bounds, F.col("lo"), F.col("hi"))


@register("m4_fct_messages", O.with_model("SELECT * FROM fct_messages", "fct_messages"))
def q_fct_messages(spark, sf_dir):
    return model_for(spark, sf_dir).fct_messages


@register("m5_fct_image_detections",
          O.with_model("SELECT * FROM fct_image_detections", "fct_image_detections"))
def q_fct_detections(spark, sf_dir):
    return model_for(spark, sf_dir).fct_image_detections


# --- reports (R1-R5) --------------------------------------------------------

def _words_and_phrases(keywords: list[str]) -> tuple[list[str], list[str]]:
    own = list(dict.fromkeys(keywords))
    return [k for k in own if " " not in k], [k for k in own if " " in k]


def _top_products_sql(keywords: list[str], limit: int, group: bool = False) -> str:
    """The keyword rule in SQL: words counted per token, each phrase by its own
    aggregate (a hit adds the text's token count)."""
    words, phrases = _words_and_phrases(keywords)
    g = "channel_username, " if group else ""
    by = "GROUP BY channel_username" if group else ""
    msgs = (f"msgs AS (SELECT {g}lower(message_text) AS lt, "
            f"regexp_extract_all(lower(message_text), '[\\p{{L}}\\p{{N}}_]+') AS toks "
            f"FROM fct_messages WHERE message_text IS NOT NULL)")
    arms = []
    if words:
        wl = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
        arms.append(f"SELECT {g}w AS product_name, CAST(count(*) AS BIGINT) AS mention_count "
                    f"FROM (SELECT {g}unnest(toks) AS w FROM msgs) t WHERE w IN ({wl}) GROUP BY {g}w")
    for p in phrases:
        q = p.replace("'", "''")
        arms.append(f"SELECT {g}'{q}' AS product_name, CAST(sum(len(toks)) AS BIGINT) AS mention_count "
                    f"FROM msgs WHERE contains(lt, '{q}') {by}")
    if not arms:
        arms.append("SELECT CAST(NULL AS VARCHAR) AS product_name, CAST(NULL AS BIGINT) AS mention_count "
                    "WHERE false")
    hits = "hits AS (" + "\n  UNION ALL ".join(arms) + ")"
    tail = "SELECT * FROM hits WHERE mention_count > 0"
    if not group:
        tail += f" ORDER BY mention_count DESC, product_name LIMIT {limit}"
    return O.with_model(tail, "fct_messages", extra=[msgs, hits])


@register("r1_top_products", _top_products_sql(PARITY_KEYWORDS, 3))
def q_top_products(spark, sf_dir):
    return R.top_products(model_for(spark, sf_dir).staging, PARITY_KEYWORDS, limit=3)


# A keyword table taken from the texts: every word, and the first two words of each text.
_KEYWORD_TABLE = """
kw AS (
  SELECT DISTINCT k FROM (
    SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS k FROM documents
    UNION ALL
    SELECT lower(p[1] || ' ' || p[2]) FROM (SELECT string_split_regex(text, ' +') AS p FROM documents)
    WHERE len(p) >= 2 AND p[1] <> '' AND p[2] <> ''
      AND NOT regexp_matches(p[1] || p[2], '\\s')
  ) t WHERE k IS NOT NULL
)"""


@register("a6_keyword_table", O.with_model("""
SELECT product_name, CAST(sum(n) AS BIGINT) AS mention_count FROM (
  SELECT k AS product_name, count(*) AS n
  FROM (SELECT unnest(toks) AS w FROM msgs) t JOIN kw ON kw.k = t.w GROUP BY k
  UNION ALL
  SELECT k, sum(len(toks)) FROM msgs JOIN kw ON position(' ' IN k) > 0 AND contains(lt, k) GROUP BY k
) h GROUP BY product_name HAVING sum(n) > 0""", "raw_messages", extra=[
    """msgs AS (SELECT lower(message_text) AS lt, regexp_extract_all(lower(message_text), '[\\p{L}\\p{N}_]+') AS toks
             FROM raw_messages WHERE message_text IS NOT NULL)""", _KEYWORD_TABLE.strip()]))
def q_keyword_table(spark, sf_dir):
    """Keyword frequency of a whole dictionary table: words and phrases."""
    from chanlytics.functions.text import tokens
    from chanlytics.operators.keywords import keyword_hits

    docs = D.table(spark, sf_dir, "documents")
    words = docs.select(F.explode(tokens(F.lower("text"))).alias("keyword"))
    p = F.split("text", " +")
    first, second = F.get(p, 0), F.get(p, 1)
    pairs = (docs.where((F.size(p) >= 2) & (first != "") & (second != ""))
             .where(~F.rlike(F.concat(first, second), F.lit(r"\s")))
             .select(F.lower(F.concat(first, F.lit(" "), second)).alias("keyword")))
    return keyword_hits(D.raw_messages(spark, sf_dir), words.union(pairs).distinct())


@register("r1_top_products_default_keywords",
          _top_products_sql(__import__("chanlytics.model", fromlist=["x"]).DEFAULT_KEYWORDS, 10))
def q_top_products_default(spark, sf_dir):
    return R.top_products(model_for(spark, sf_dir).staging, None, limit=10)


@register("r2_channel_activity", f"""
SELECT DATE '2024-01-01' + CAST(day AS INTEGER) AS activity_date, n AS message_count
FROM (SELECT doc_id % 90 AS day, count(*) AS n FROM documents WHERE source = '{ACTIVITY_CHANNEL}' GROUP BY 1)""")
def q_channel_activity(spark, sf_dir):
    m = model_for(spark, sf_dir)
    return R.channel_activity(m.fct_messages, m.dim_channels, m.dim_dates, ACTIVITY_CHANNEL)


_FCT_COLS = ("message_sk, message_id, channel_sk, channel_username, message_date_sk, scrape_date_sk, "
             "message_text, message_length, views, forwards, has_photo, photo_path, "
             "is_urgent_message, is_vacancy_message, message_count")


@register("r3_search_messages", O.with_model(f"""
SELECT {_FCT_COLS} FROM fct_messages
WHERE lower(message_text) LIKE '%{SEARCH_QUERY}%'
ORDER BY message_date_sk DESC NULLS FIRST, message_sk LIMIT 100""", "fct_messages"))
def q_search(spark, sf_dir):
    return R.search_messages(model_for(spark, sf_dir).fct_messages, SEARCH_QUERY)


WILD_QUERY = "t_e%ion\\s"  # wildcards, and a backslash that makes the next character plain


@register("r3_search_wildcards", O.with_model(f"""
SELECT {_FCT_COLS} FROM fct_messages
WHERE lower(message_text) LIKE '%{WILD_QUERY}%' ESCAPE '\\'
ORDER BY message_date_sk DESC NULLS FIRST, message_sk LIMIT 100""", "fct_messages"))
def q_search_wildcards(spark, sf_dir):
    return R.search_messages(model_for(spark, sf_dir).fct_messages, WILD_QUERY)


RARE_QUERY = "qu_osta"  # in a few texts: most files lack one of its trigrams


@register("r3_search_postings", O.with_model(f"""
SELECT {_FCT_COLS} FROM fct_messages
WHERE lower(message_text) LIKE '%{RARE_QUERY}%'
ORDER BY message_date_sk DESC NULLS FIRST, message_sk LIMIT 100""", "fct_messages"))
def q_search_postings(spark, sf_dir):
    """The fact stored in files by message, with the postings of its trigrams; then a search."""
    from chanlytics.operators.search_index import write_postings
    from chanlytics.plans.daily import write_table

    folder = scratch(spark, "search")
    fct = write_table(model_for(spark, sf_dir).fct_messages.repartition(64, "message_sk"), f"{folder}/fct_messages")
    postings = write_postings(spark, f"{folder}/fct_messages", f"{folder}/trigrams")
    return R.search_messages(fct, RARE_QUERY, postings=postings)


@register("r4_list_channels_by_language", O.with_model(
    "SELECT channel_sk, channel_username, channel_name FROM dim_channels", "dim_channels"))
def q_list_channels_by_language(spark, sf_dir):
    """Channels in the order of a language's collation."""
    return R.list_channels(model_for(spark, sf_dir).dim_channels, "UNICODE")


@register("r4_list_channels", O.with_model(
    "SELECT channel_sk, channel_username, channel_name FROM dim_channels "
    "ORDER BY channel_name, channel_username", "dim_channels"))
def q_list_channels(spark, sf_dir):
    return R.list_channels(model_for(spark, sf_dir).dim_channels)


_DET_COLS = ("image_detection_sk, message_sk, detected_object_class, confidence_score, "
             "image_path, detection_timestamp")


@register("r5_image_detections", O.with_model(
    f"SELECT {_DET_COLS} FROM fct_image_detections ORDER BY image_detection_sk LIMIT 100",
    "fct_image_detections"))
def q_image_detections(spark, sf_dir):
    return R.image_detections(model_for(spark, sf_dir).fct_image_detections)


DETECTION_MESSAGE = "4-src4"  # message 4 of channel src4


@register("r5_image_detections_of_message", O.with_model(f"""
SELECT {_DET_COLS} FROM fct_image_detections
WHERE message_sk = md5('{DETECTION_MESSAGE}')
ORDER BY image_detection_sk LIMIT 100""", "fct_image_detections"))
def q_image_detections_msg(spark, sf_dir):
    import hashlib

    sk = hashlib.md5(DETECTION_MESSAGE.encode()).hexdigest()
    return R.image_detections(model_for(spark, sf_dir).fct_image_detections, sk)


# --- data quality (Q1-Q7) ---------------------------------------------------

from chanlytics.operators import quality as Q  # noqa: E402

_CHECK_ALIASES = [
    "raw_image_detections AS (SELECT * FROM raw_detections)",
    "stg_messages AS (SELECT * FROM staging)",
]


@register("q1_q5_q7_quality_suite",
          O.with_model(Q.checks_sql(), "fct_image_detections", "fct_messages", "staging", "dim_channels",
                       "dim_dates", extra=_CHECK_ALIASES))
def q_quality(spark, sf_dir):
    return Q.run_checks(stored_tables(spark, sf_dir))


def stored_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The model's tables, written once and read back, as the daily job has them."""
    from chanlytics.plans.daily import Layout, build_marts, write_table

    layout = Layout(scratch(spark, "model"), "")
    raw = write_table(D.raw_messages(spark, sf_dir), layout.table("raw_messages"))
    det = write_table(D.raw_detections(spark, sf_dir), layout.table("raw_image_detections"))
    return build_marts(spark, raw, det, layout)


# Defects for every check: copies of some rows of each table, one with each
# declared column empty, one repeated, one with a key that no parent has.
_SOME = {
    "raw_messages": "message_id % 50 = 7", "raw_image_detections": "message_id % 50 = 7",
    "stg_messages": "message_id % 50 = 7", "dim_channels": "channel_username = 'src3'",
    "dim_dates": "day_of_month = 1", "fct_messages": "message_id % 50 = 7",
    "fct_image_detections": "image_path LIKE '%7.jpg'",
}
_WRONG = {  # table -> (column, wrong value as SQL) of the predicate checks
    "stg_messages": [("photo_path", "CASE WHEN has_photo THEN NULL ELSE 'x' END")],
    "fct_image_detections": [("confidence_score", "CAST(1.5 AS DECIMAL(5, 4))")],
}


def _defects(table: str) -> list[tuple[str, str]]:
    kinds = Q.DECLARED_TESTS[table]
    out = [(c, "NULL") for c in kinds.get("not_null", [])]
    out += [(c, c) for c in kinds.get("unique", [])[:1]]
    for column, to, _ in kinds.get("relationships", []):
        out.append((column, "-1" if to == "dim_dates" else "'orphan'"))
    return out + _WRONG.get(table, [])


def _defects_sql() -> str:
    ctes = []
    for t in Q.DECLARED_TESTS:
        source = {"stg_messages": "staging", "raw_image_detections": "raw_detections"}.get(t, t)
        arms = [f"SELECT * FROM {source}"]
        arms += [f"SELECT * REPLACE ({v} AS {c}) FROM {source} WHERE {_SOME[t]}" for c, v in _defects(t)]
        ctes.append(f"bad_{t} AS ({' UNION ALL '.join(arms)})")
    return O.with_model(Q.checks_sql(prefix="bad_"), "fct_image_detections", "fct_messages", "staging", "dim_channels",
                        "dim_dates", extra=ctes)


@register("q1_q7_quality_suite_defects", _defects_sql())
def q_quality_defects(spark, sf_dir):
    """The 48 checks over tables in which every one of them fails."""
    out = {}
    for name, df in stored_tables(spark, sf_dir).items():
        kinds = {f.name: f.dataType for f in df.schema.fields}
        some, bad = df.where(_SOME[name]), df
        for column, value in _defects(name):
            wrong = F.expr(value).cast(kinds[column])
            bad = bad.unionAll(some.select(*[wrong.alias(c) if c == column else F.col(c) for c in df.columns]))
        out[name] = bad
    return Q.run_checks(out)


def _health(spark, sf_dir, part):
    m = model_for(spark, sf_dir)
    return Q.detection_health(m.raw_detections, m.raw_messages)[part]


_USER_OF = "CASE source WHEN 'src1' THEN '@source_one' ELSE source END"


@register("q6_detections_total", "SELECT count(vec_id) AS total_detections FROM embeddings")
def q_health_total(spark, sf_dir):
    return _health(spark, sf_dir, "total")


@register("q6_detections_by_channel", f"""
SELECT coalesce({_USER_OF}, 'src0') AS channel_username, count(*) AS detections
FROM embeddings LEFT JOIN documents ON doc_id = vec_id GROUP BY 1""")
def q_health_by_channel(spark, sf_dir):
    return _health(spark, sf_dir, "by_channel")


@register("q6_duplicate_detection_ids", """
SELECT coalesce(source, 'src0') || '_' || vec_id || '.jpg_class' || label || '_0' AS detection_id, CAST(2 AS BIGINT) AS n
FROM embeddings LEFT JOIN documents ON doc_id = vec_id WHERE vec_id % 20 = 3""")
def q_health_dups(spark, sf_dir):
    """Every twentieth detection is stored twice."""
    det = D.raw_detections(spark, sf_dir)
    again = det.where(F.col("message_id") % 20 == 3)
    return Q.detection_health(det.unionAll(again), D.raw_messages(spark, sf_dir))["duplicates"]


@register("q6_detection_sample", O.with_model("""
SELECT detection_id, message_id, channel_username, image_path, detected_object_class, confidence_score
FROM (SELECT *, rank() OVER (ORDER BY detection_id) AS place FROM raw_detections) WHERE place <= 5""", "raw_detections"))
def q_health_sample(spark, sf_dir):
    return _health(spark, sf_dir, "sample")


# those without a document, and those of the channel that the mapping renames
@register("q6_orphan_detections", """
SELECT vec_id AS message_id, coalesce(source, 'src0') AS channel_username
FROM embeddings LEFT JOIN documents ON doc_id = vec_id WHERE doc_id IS NULL OR source = 'src2'""")
def q_health_orphans(spark, sf_dir):
    return _health(spark, sf_dir, "orphans")


# --- ingest (I3-I7, S7, J6) -------------------------------------------------

from chanlytics import model as _model  # noqa: E402
from chanlytics.operators import ingest as I  # noqa: E402

_LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
_LINEITEM_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                   "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LINEITEM_COLS = _LINEITEM_KEYS + _LINEITEM_ORDER


@register("i3_insert_if_absent_lineitem", f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(_LINEITEM_ORDER)}) AS rn
  FROM lineitem
), stored AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R')
SELECT {', '.join(_LINEITEM_COLS)} FROM ranked r
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM stored s
                             WHERE s.l_orderkey = r.l_orderkey AND s.l_linenumber = r.l_linenumber)""")
def q_insert_if_absent(spark, sf_dir):
    """Batch = all lineitem rows (duplicate keys inside), stored = the returned ('R') lines."""
    li = D.table(spark, sf_dir, "lineitem")
    stored = li.filter(F.col("l_returnflag") == "R").select(*_LINEITEM_KEYS)
    new = I.new_rows(li, stored, _LINEITEM_KEYS, [F.col(c) for c in _LINEITEM_ORDER])
    return new.select(*_LINEITEM_COLS)


@register("i3_keyed_target", f"""
SELECT doc_id AS message_id, {O._MAP_CASE} AS channel_username, text AS message_text,
       CASE WHEN doc_id % 3 = 0 THEN DATE '2024-04-11' ELSE DATE '2024-04-10' END AS scrape_date
FROM documents""")
def q_keyed_target(spark, sf_dir):
    """Two loads into a stored table: two thirds of the messages, then all of them, each twice; the first write stays."""
    path = scratch(spark, "keyed")
    for day, part in (("2024-04-10", "message_id % 3 <> 0"), ("2024-04-11", "true")):
        export = D.export_rows(spark, sf_dir).where(part)
        again = export.withColumns({"source_pos": F.col("source_pos") + 1, "text": F.lit("a later copy")})
        batch = I.to_raw_messages(export.unionByName(again), F.lit(day).cast("date"), D.CHANNEL_MAP)
        I.append_if_absent(spark, batch, path, _model.RAW_MESSAGES_SCHEMA, _model.RAW_MESSAGES_KEY,
                           [F.col("source_file"), F.col("source_pos")])
    stored = I.read_table(spark, path, _model.RAW_MESSAGES_SCHEMA)
    return stored.select("message_id", "channel_username", "message_text", "scrape_date")


_EXPORT_ROWS_SQL = """
export_rows AS (
  SELECT doc_id AS message_id, source AS channel,
         (DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) + CAST(doc_id % 5 AS INTEGER)) AS scrape_date,
         CAST(DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) + CAST(doc_id % 5 AS INTEGER) AS VARCHAR)
           || '/' || source || '.json' AS source_file,
         doc_id AS source_pos, lang
  FROM documents
)"""


@register("i5_load_accounting", f"""
WITH {_EXPORT_ROWS_SQL.strip()},
ranked AS (SELECT *, row_number() OVER (PARTITION BY message_id, channel ORDER BY source_file, source_pos) AS rn
           FROM export_rows),
stored AS (SELECT DISTINCT message_id, channel FROM export_rows WHERE lang = 'en')
SELECT source_file,
       CAST(count(*) FILTER (WHERE rn = 1 AND s.message_id IS NULL) AS BIGINT) AS recorded,
       CAST(count(*) FILTER (WHERE NOT (rn = 1 AND s.message_id IS NULL)) AS BIGINT) AS skipped
FROM ranked r LEFT JOIN stored s ON s.message_id = r.message_id AND s.channel = r.channel
GROUP BY source_file""")
def q_load_accounting(spark, sf_dir):
    """A day's exports loaded into a table that already holds the English documents."""
    ex = D.export_rows(spark, sf_dir)
    raw = I.to_raw_messages(ex, F.col("scrape_date"), D.CHANNEL_MAP)
    stored = D.raw_messages(spark, sf_dir).join(
        D.table(spark, sf_dir, "documents").filter(F.col("lang") == "en")
        .select(F.col("doc_id").alias("message_id")), "message_id", "left_semi")
    new = I.new_rows(raw, stored, _model.RAW_MESSAGES_KEY,
                     [F.col("source_file"), F.col("source_pos")])
    return I.load_accounting(raw, new)


@register("s7_j6_new_images", O.with_model("""
SELECT DISTINCT photo_path AS image_path FROM raw_messages m
WHERE photo_path IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM raw_detections d WHERE d.image_path = m.photo_path)""",
    "raw_messages", "raw_detections"))
def q_new_images(spark, sf_dir):
    """Photos referenced by messages that have no detection yet."""
    m = model_for(spark, sf_dir)
    images = m.raw_messages.filter(F.col("photo_path").isNotNull()) \
        .select(F.col("photo_path").alias("image_path")).distinct()
    return I.new_images(images, m.raw_detections)


_TARGETS = {f"@src{i}": f"Src{i}" for i in range(10)}
_PHOTO = ["Src0", "Src1"]


@register("e3_normalise_export", f"""
WITH fetched AS (
  SELECT doc_id AS message_id, '@' || source AS channel_username,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) AS posted_at,
         text,
         CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(n_chars % 500 AS INTEGER) END AS views,
         CAST(doc_id % 7 AS INTEGER) AS forwards,
         CASE WHEN doc_id % 3 = 0 THEN 'photo' WHEN doc_id % 3 = 1 THEN 'document' END AS media_type
  FROM documents
), known AS (
  SELECT f.*, 'Src' || substr(channel_username, 5) AS channel FROM fetched f
  WHERE channel_username IN ({', '.join("'" + k + "'" for k in sorted(_TARGETS))})
), latest AS (
  SELECT *, row_number() OVER (PARTITION BY channel ORDER BY message_id DESC) AS rn FROM known
)
SELECT message_id, channel, CAST(posted_at AS DATE) AS date, coalesce(text, '') AS text,
       CAST(coalesce(views, 0) AS INTEGER) AS views, CAST(coalesce(forwards, 0) AS INTEGER) AS forwards,
       coalesce(media_type = 'photo', false) AS has_photo,
       CASE WHEN channel IN ({', '.join("'" + c + "'" for c in _PHOTO)}) AND coalesce(media_type = 'photo', false)
            THEN 'data/images/' || channel || '_' || CAST(message_id AS VARCHAR) || '.jpg' END AS photo_path
FROM latest WHERE rn <= 20""")
def q_normalise_export(spark, sf_dir):
    from chanlytics.operators.export import normalise_export

    return normalise_export(D.fetched_messages(spark, sf_dir), _TARGETS, _PHOTO, limit=20)[0]


@register("f10_rejected_channels", f"""
SELECT doc_id AS message_id, '@' || source AS channel_username FROM documents
WHERE '@' || source NOT IN ({', '.join("'" + k + "'" for k in sorted(_TARGETS))})""")
def q_rejected_channels(spark, sf_dir):
    """The messages of channels that are not in the exporter's list."""
    from chanlytics.operators.export import normalise_export

    rejects = normalise_export(D.fetched_messages(spark, sf_dir), _TARGETS, _PHOTO)[1]
    return rejects.select("message_id", "channel_username")


# --- business questions (B1-B6) ---------------------------------------------

@register("b1_daily_volume", """
SELECT DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) AS activity_date, count(*) AS message_count
FROM documents GROUP BY doc_id % 90""")
def q_daily_volume(spark, sf_dir):
    m = model_for(spark, sf_dir)
    return R.daily_volume(m.fct_messages, m.dim_dates)


@register("b3_visual_share", O.with_model("""
SELECT dc.channel_username, CAST(count(*) AS BIGINT) AS message_count,
       CAST(sum(CASE WHEN fm.has_photo THEN 1 ELSE 0 END) AS BIGINT) AS photo_count,
       CAST(floor(sum(CASE WHEN fm.has_photo THEN 1 ELSE 0 END) * 1000 / count(*)) AS BIGINT) AS photo_per_mille
FROM fct_messages fm LEFT JOIN dim_channels dc ON fm.channel_sk = dc.channel_sk
GROUP BY fm.channel_sk, dc.channel_username""", "fct_messages", "dim_channels"))
def q_visual_share(spark, sf_dir):
    m = model_for(spark, sf_dir)
    return R.visual_share(m.fct_messages, m.dim_channels)


@register("b4_object_mix", O.with_model("""
SELECT fm.channel_username, fd.detected_object_class, CAST(sum(fd.detection_count) AS BIGINT) AS detection_count
FROM fct_image_detections fd JOIN fct_messages fm ON fd.message_sk = fm.message_sk
WHERE fd.message_sk IS NOT NULL
GROUP BY fm.channel_username, fd.detected_object_class""", "fct_image_detections", "fct_messages"))
def q_object_mix(spark, sf_dir):
    m = model_for(spark, sf_dir)
    return R.object_mix(m.fct_image_detections, m.fct_messages)


@register("b5_product_by_channel", _top_products_sql(PARITY_KEYWORDS, 0, group=True))
def q_product_by_channel(spark, sf_dir):
    return R.product_by_channel(model_for(spark, sf_dir).staging, PARITY_KEYWORDS)


def _hit_filter_sql(keywords: list[str]) -> str:
    words, phrases = _words_and_phrases(keywords)
    toks = "regexp_extract_all(lower(message_text), '[\\p{L}\\p{N}_]+')"
    conds = []
    if words:
        wl = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
        conds.append(f"list_has_any({toks}, [{wl}])")
    for p in phrases:
        conds.append(f"(contains(lower(message_text), '{p}') AND len({toks}) > 0)")
    return "message_text IS NOT NULL AND (" + (" OR ".join(conds) or "false") + ")"


@register("b2_weekly_keyword_volume", O.with_model(f"""
SELECT CAST(date_trunc('week', dd.full_date) AS DATE) AS week_start,
       CAST(count(*) AS BIGINT) AS message_count
FROM fct_messages fm JOIN dim_dates dd ON fm.message_date_sk = dd.date_sk
WHERE {_hit_filter_sql(PARITY_KEYWORDS)}
GROUP BY 1 ORDER BY 1""", "fct_messages", "dim_dates"))
def q_weekly_keyword_volume(spark, sf_dir):
    m = model_for(spark, sf_dir)
    return R.weekly_keyword_volume(M.with_date_key(m.staging, m.dim_dates), m.dim_dates, PARITY_KEYWORDS)


def _price_sql(keywords: list[str]) -> str:
    """Word by word: a keyword at place i, the first amount among the next four words."""
    kws = ", ".join(
        "('" + k + "', [" + ", ".join("'" + x + "'" for x in k.split()) + "])" for k in dict.fromkeys(keywords))
    return O.with_model(f"""
SELECT channel_username, product_name, count(*) AS n_prices, min(price) AS min_price,
       quantile_disc(price, 0.5) AS median_price, max(price) AS max_price
FROM (
  SELECT channel_username, k AS product_name,
         TRY_CAST(CASE WHEN regexp_full_match(t, '[0-9]+,[0-9]{{1,2}}') THEN replace(t, ',', '.')
                       ELSE replace(t, ',', '') END AS DECIMAL(18, 2)) AS price
  FROM (
    SELECT channel_username, k, list_filter(ws[i + len(parts):i + len(parts) + 3], lambda x:
             regexp_full_match(x, '[0-9]{{1,3}}(,[0-9]{{3}})+([.][0-9]{{1,2}})?')
             OR regexp_full_match(x, '[0-9]+([.,][0-9]{{1,2}})?'))[1] AS t
    FROM spoken, (VALUES {kws}) AS kw(k, parts), unnest(range(1, len(ws) + 1)) AS r(i)
    WHERE ws[i:i + len(parts) - 1] = parts
  ) m WHERE t IS NOT NULL
) p WHERE price IS NOT NULL
GROUP BY channel_username, product_name""", "fct_messages", extra=["""
spoken AS (
  SELECT channel_username, list_transform(
           list_filter(string_split_regex(lower(message_text), '[ \\t\\r\\n]+'), lambda x: x <> ''),
           lambda x: regexp_replace(x, '^[^\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+$', '', 'g')) AS ws
  FROM fct_messages WHERE message_text IS NOT NULL
)"""])


@register("b6_price_variation", _price_sql(PARITY_KEYWORDS))
def q_price_variation(spark, sf_dir):
    return R.price_variation(model_for(spark, sf_dir).staging, PARITY_KEYWORDS)


# --- enrichment (E1, E2) ----------------------------------------------------

DETECT_MIN_CONFIDENCE = 0.2


def _detector_inputs(spark, sf_dir):
    from chanlytics.operators.detect import CentroidScorer, fit_centroids

    img = D.image_paths(spark, sf_dir)
    cents, labels = fit_centroids(D.table(spark, sf_dir, "embeddings"))
    scorer = CentroidScorer(cents, [f"class{k}" for k in labels], DETECT_MIN_CONFIDENCE)
    # the loader's own channel mapping, derived from the messages
    mapping = D.raw_messages(spark, sf_dir).select(
        F.col("channel_name").alias("channel"), "channel_username").distinct()
    images = img.select(F.col("image_path").alias("path"), F.col("embedding").alias("content"))
    return images, scorer, mapping


_DETECT_SQL = f"""
WITH image_src AS (
  SELECT v.vec_id, coalesce(d.source, 'src0') AS channel, v.label, v.embedding
  FROM embeddings v LEFT JOIN documents d ON d.doc_id = v.vec_id
), mapping AS (SELECT DISTINCT source AS channel, CASE source WHEN 'src1' THEN '@source_one' WHEN 'src2' THEN '@source_two'
                            ELSE source END AS channel_username FROM documents),
cent_dim AS (
  SELECT label, pos, avg(CAST(x AS DOUBLE)) AS v
  FROM (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM embeddings) e
  GROUP BY label, pos
), cent AS (SELECT label, list(v ORDER BY pos) AS c FROM cent_dim GROUP BY label),
model AS (SELECT list(label ORDER BY label) AS labels, list(c ORDER BY label) AS cs FROM cent),
scored AS (
  SELECT vec_id, channel, channel_username, unnest(labels) AS cls, unnest(sims) AS sim
  FROM (SELECT i.vec_id, i.channel, m.channel_username, (SELECT labels FROM model) AS labels,
               list_transform((SELECT cs FROM model),
                              lambda c: list_cosine_similarity(CAST(i.embedding AS DOUBLE[]), c)) AS sims
        FROM image_src i JOIN mapping m ON m.channel = i.channel) s
), boxes AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, cls) - 1 AS box_idx
  FROM scored WHERE sim >= {DETECT_MIN_CONFIDENCE}
)
SELECT channel || '_' || CAST(vec_id AS VARCHAR) || '.jpg_class' || CAST(cls AS VARCHAR) || '_' || CAST(box_idx AS VARCHAR) AS detection_id,
       vec_id AS message_id, channel_username,
       'data/images/' || channel || '_' || CAST(vec_id AS VARCHAR) || '.jpg' AS image_path,
       'class' || CAST(cls AS VARCHAR) AS detected_object_class,
       CAST(round(sim, 4) AS DECIMAL(5, 4)) AS confidence_score,
       TIMESTAMP '2024-04-01 00:00:00' AS detection_timestamp
FROM boxes"""


@register("e1_detect_objects", _DETECT_SQL)
def q_detect(spark, sf_dir):
    """Every image of the embeddings table scored by the centroid stand-in detector."""
    from chanlytics.operators.detect import detect_objects

    images, scorer, mapping = _detector_inputs(spark, sf_dir)
    return detect_objects(images, scorer, D.DETECTION_TIME, mapping).detections


@register("e2_scan_log", f"""
WITH b AS ({_DETECT_SQL})
SELECT 'data/images/' || coalesce(d.source, 'src0') || '_' || CAST(v.vec_id AS VARCHAR) || '.jpg' AS image_path,
       CAST((SELECT count(*) FROM b WHERE b.message_id = v.vec_id) AS INTEGER) AS n_boxes,
       TIMESTAMP '2024-04-01 00:00:00' AS scored_at
FROM embeddings v LEFT JOIN documents d ON d.doc_id = v.vec_id""")
def q_scan_log(spark, sf_dir):
    """One row per scored image, zero-box images included."""
    from chanlytics.operators.detect import detect_objects

    images, scorer, mapping = _detector_inputs(spark, sf_dir)
    return detect_objects(images, scorer, D.DETECTION_TIME, mapping).scan_log


@register("i4_insert_if_absent_detections", "WITH " + O.RAW_DETECTIONS.strip() + f""",
scored AS ({_DETECT_SQL})
SELECT s.* FROM scored s
WHERE NOT EXISTS (SELECT 1 FROM raw_detections r WHERE r.detection_id = s.detection_id)""")
def q_insert_detections(spark, sf_dir):
    """Detector output appended to the stored detections: ids already stored are skipped."""
    from chanlytics.operators.detect import detect_objects

    images, scorer, mapping = _detector_inputs(spark, sf_dir)
    batch = detect_objects(images, scorer, D.DETECTION_TIME, mapping).detections
    stored = D.raw_detections(spark, sf_dir)
    return I.new_rows(batch, stored, _model.RAW_DETECTIONS_KEY, [F.col("detection_id")])


# --- image files (S4, T2): the embeddings written as files, some of them no images ---

_FILE_NAME = ("coalesce(d.source, 'src0') || '_' || CAST(v.vec_id AS VARCHAR) || "
              "CASE v.vec_id % 5 WHEN 0 THEN '.txt' WHEN 1 THEN '.JPG' ELSE '.jpg' END")


def _image_files(spark, sf_dir) -> DataFrame:
    ending = F.when(F.col("vec_id") % 5 == 0, ".txt").when(F.col("vec_id") % 5 == 1, ".JPG").otherwise(".jpg")
    return D.image_paths(spark, sf_dir).withColumn("image_path", F.concat(F.regexp_replace("image_path", r"\.jpg$", ""), ending))


@register("s4_image_scan", f"""
SELECT {_FILE_NAME} AS file_name FROM embeddings v LEFT JOIN documents d ON d.doc_id = v.vec_id WHERE v.vec_id % 5 <> 0""")
def q_image_scan(spark, sf_dir):
    """The image files of a folder that holds other files as well."""
    from chanlytics.operators.detect import list_images

    folder = scratch(spark, "images")
    D.write_image_files(_image_files(spark, sf_dir), folder)
    return list_images(spark, folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"))


@register("t2_incremental_detection", f"""
SELECT * REPLACE (replace(detection_id, '.jpg', CASE message_id % 5 WHEN 1 THEN '.JPG' ELSE '.jpg' END) AS detection_id,
                  replace(image_path, '.jpg', CASE message_id % 5 WHEN 1 THEN '.JPG' ELSE '.jpg' END) AS image_path)
FROM ({_DETECT_SQL.strip()}) b WHERE message_id % 5 <> 0""")
def q_incremental_detection(spark, sf_dir):
    """Image files arrive in two steps, and a stream is started after each; every image is scored once."""
    from chanlytics.operators.detect import CentroidBytesScorer, fit_centroids
    from chanlytics.streaming import start_image_scoring

    base = scratch(spark, "images")
    centroids, labels = fit_centroids(D.table(spark, sf_dir, "embeddings"))
    scorer = CentroidBytesScorer(centroids, [f"class{k}" for k in labels], DETECT_MIN_CONFIDENCE)
    mapping = D.raw_messages(spark, sf_dir).select(F.col("channel_name").alias("channel"), "channel_username").distinct()
    images = _image_files(spark, sf_dir)
    for step in (0, 1):
        D.write_image_files(images.where(F.col("vec_id") % 2 == step), base + "/files")
        start_image_scoring(spark, base + "/files", scorer, base + "/detections", base + "/state", base + "/log",
                            mapping=mapping, run_ts=D.DETECTION_TIME).awaitTermination()
    return I.read_table(spark, base + "/detections", _model.RAW_DETECTIONS_SCHEMA)


# --- the same operators over the larger driver tables -------------------------

_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("w1_latest_event_per_user", f"""
SELECT {', '.join(_EVENT_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
  FROM events) e
WHERE rn = 1""")
def q_latest_event(spark, sf_dir):
    """W1/F5 on a history table: the latest event of every user (ties by event id)."""
    from chanlytics.operators.topk import latest_per_key

    ev = D.table(spark, sf_dir, "events")
    return latest_per_key(ev, ["user_id"],
                          [F.col("ts").desc_nulls_first(), F.col("event_id").desc()]) \
        .select(*_EVENT_COLS)


_KEY_CHECKS = [
    Q.Check("not_null", "customer", "c_custkey"),
    Q.Check("not_null", "orders", "o_orderkey"),
    Q.Check("not_null", "lineitem", "l_orderkey"),
    Q.Check("not_null", "documents", "text"),
    Q.Check("unique", "customer", "c_custkey"),
    Q.Check("unique", "orders", "o_orderkey"),
    Q.Check("unique", "documents", "doc_id"),
    Q.Check("unique", "lineitem", "l_orderkey"),
    Q.Check("relationships", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    Q.Check("relationships", "orders", "o_custkey", "customer", "c_custkey"),
    Q.Check("relationships", "customer", "c_nationkey", "nation", "n_nationkey"),
    Q.Check("relationships", "nation", "n_regionkey", "region", "r_regionkey"),
    Q.Check("relationships", "labels", "doc_id", "documents", "doc_id"),
    Q.Check("expression", "lineitem", "l_discount", predicate="NOT (l_discount BETWEEN 0 AND 1)",
            name="custom:lineitem_discount_between_0_and_1"),
]


@register("q_key_checks_driver_tables", Q.checks_sql(_KEY_CHECKS))
def q_key_checks(spark, sf_dir):
    """The check suite (not_null, unique, relationships, predicate) over the whole driver tables."""
    names = {c.table for c in _KEY_CHECKS} | {c.to_table for c in _KEY_CHECKS if c.to_table}
    return Q.run_checks({n: D.table(spark, sf_dir, n) for n in names}, _KEY_CHECKS)


# --- landing connector round trip (I1, S1-S3, G2, I6) --------------------------

@register("s1_i1_landing_roundtrip", """
SELECT doc_id AS message_id, source AS channel,
       DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) AS date,
       text, CAST(n_chars % 500 AS INTEGER) AS views, CAST(doc_id % 7 AS INTEGER) AS forwards,
       (doc_id % 3 = 0) AS has_photo,
       CASE WHEN doc_id % 6 = 0
            THEN 'data/images/' || source || '_' || CAST(doc_id AS VARCHAR) || '.jpg' END AS photo_path,
       DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) + CAST(doc_id % 5 AS INTEGER) AS scrape_date
FROM documents""")
def q_landing_roundtrip(spark, sf_dir):
    """The documents' export written by the landing writer, read back and checked.

    The files go to a fresh folder under the session's checkpoint folder;
    reading uses the splittable JSON-lines reader, the record checks and the
    whole-export rejection.
    """
    from chanlytics.sources.exports import write_landing

    base = scratch(spark, "landing")
    write_landing(D.export_rows(spark, sf_dir), base)
    typed, _rejected = I.validate_landing_rows(I.read_landing_day(spark, base))
    return typed.drop("source_file", "source_pos")


# --- the exporter's own files: one JSON array a channel and day (S1, G2, S3, I6) -

# Each file has a number from its date and channel; some numbers get a defect.
_FILE_NUMBER = ("(CAST(substr(source_file, 9, 2) AS INTEGER) + "
                "CAST(regexp_extract(source_file, 'src([0-9]+)', 1) AS INTEGER)) % 20")
_REASONS = {0: "unparsable", 1: "unparsable", 2: "missing_key", 3: "value_too_long", 4: "null_channel", 6: "bad_date",
            7: "bad_message_id", 8: "bad_number", 9: "bad_boolean", 10: "value_too_long"}
_LONG_NAME = "O'" + "x" * 300


def _array_files(spark, sf_dir) -> str:
    """The documents' exports as array files in a fresh folder, some of them spoilt."""
    from chanlytics.sources.exports import array_files, write_exports

    files = array_files(D.export_rows(spark, sf_dir)).withColumn("k", F.expr(_FILE_NUMBER))
    c = F.col("content")
    made = {0: F.substring(c, F.lit(1), F.length(c) - 1), 1: F.concat(c, F.lit(" trailing")),
            2: F.regexp_replace(c, '"views":', '"view":'), 3: F.regexp_replace(c, '"channel":"', '"channel":"' + "x" * 256),
            4: F.regexp_replace(c, '"channel":"[^"]*"', '"channel":null'), 5: F.lit("[]"),
            6: F.regexp_replace(c, '"date":"2024', '"date":"nope'),
            7: F.regexp_replace(c, '"message_id":', '"message_id":"a",  "old":'),
            8: F.regexp_replace(c, '"views":', '"views":1.5e99, "old":'),
            9: F.regexp_replace(c, '"has_photo":', '"has_photo":"maybe", "old":'),
            10: F.regexp_replace(c, '"channel":"[^"]*"', '"channel":"long"')}
    out = c
    for k, v in made.items():
        out = F.when(F.col("k") == k, v).otherwise(out)
    base = scratch(spark, "arrays")
    write_exports(files.select("source_file", "part", out.alias("content")), base)
    return base


_ARRAY_CHANNELS = D.CHANNEL_MAP | {"long": _LONG_NAME, "it's": "O'Neil"}


def _judged(spark, sf_dir):
    from chanlytics.sources.exports import read_export_files

    return I.judge_exports(read_export_files(spark, _array_files(spark, sf_dir)), _ARRAY_CHANNELS)


_GOOD_EXPORT = f"""
export_rows AS (
  SELECT doc_id, source, text, n_chars, DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) AS date,
         CAST(DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) + CAST(doc_id % 5 AS INTEGER) AS VARCHAR)
           || '/' || source || '.json' AS source_file
  FROM documents
), numbered AS (SELECT *, {_FILE_NUMBER} AS k FROM export_rows)"""


@register("s1_g2_array_scan", f"""
WITH {_GOOD_EXPORT.strip()}
SELECT doc_id AS message_id, source AS channel, date, text, CAST(n_chars % 500 AS INTEGER) AS views,
       CAST(doc_id % 7 AS INTEGER) AS forwards, (doc_id % 3 = 0) AS has_photo,
       CASE WHEN doc_id % 6 = 0
            THEN 'data/images/' || source || '_' || CAST(doc_id AS VARCHAR) || '.jpg' END AS photo_path,
       source_file, row_number() OVER (PARTITION BY source_file ORDER BY doc_id) - 1 AS source_pos
FROM numbered WHERE k NOT IN ({', '.join(map(str, [*_REASONS, 5]))})""")
def q_array_scan(spark, sf_dir):
    """The records of the accepted array files; whole files with a defect are left out."""
    return _judged(spark, sf_dir)[0].drop("scrape_date")


@register("i6_rejected_files", f"""
WITH {_GOOD_EXPORT.strip()}
SELECT source_file, CASE WHEN k > 1 THEN CAST(count(*) AS INTEGER) END AS n_records,
       CASE k {' '.join(f"WHEN {k} THEN '{v}'" for k, v in _REASONS.items())} END AS reason
FROM numbered WHERE k IN ({', '.join(map(str, _REASONS))}) GROUP BY source_file, k""")
def q_rejected_files(spark, sf_dir):
    """The rejected files, each with its reason."""
    return _judged(spark, sf_dir)[2].select(
        "source_file", F.when(F.col("reason") != "unparsable", F.col("n_records")).alias("n_records"), "reason")


@register("s3_i5_accounting_with_empty_files", f"""
WITH {_GOOD_EXPORT.strip()}
SELECT source_file, CASE WHEN k = 5 THEN 0 ELSE count(*) END AS recorded, CAST(0 AS BIGINT) AS skipped
FROM numbered WHERE k NOT IN ({', '.join(map(str, _REASONS))}) GROUP BY source_file, k""")
def q_empty_files(spark, sf_dir):
    """The loader over all days' files: records loaded from each accepted file; empty files count with none."""
    base = _array_files(spark, sf_dir)
    return I.load_exports(spark, base, None, base + "-raw", mapping=_ARRAY_CHANNELS)[0]


# --- the lines layout: names like numbers, repeated records -----------------------

@register("i3_lines_first_write_wins", """
SELECT CAST(doc_id % 40 AS BIGINT) AS message_id, lpad(CAST(doc_id % 3 AS VARCHAR), 3, '0') AS channel_name,
       arg_min(text, doc_id) AS message_text
FROM documents GROUP BY 1, 2""")
def q_lines_first(spark, sf_dir):
    """Channels named 000 to 002; of a message's records the first written is stored."""
    import datetime as dt

    from chanlytics.sources.exports import write_landing

    base, day = scratch(spark, "landing"), dt.date(2024, 4, 10)
    rows = D.export_rows(spark, sf_dir).select(
        (F.col("message_id") % 40).alias("message_id"),
        F.lpad((F.col("message_id") % 3).cast("string"), 3, "0").alias("channel"),
        "date", "text", "views", "forwards", "has_photo", "photo_path", "source_pos", F.lit(day).alias("scrape_date"))
    write_landing(rows, base)
    I.load_landing_day(spark, base, day, base + "-raw")
    return spark.read.parquet(base + "-raw").select("message_id", "channel_name", "message_text")


# --- the jobs themselves (D1, I2, I8, T1) ------------------------------------------

_DAY = "2024-04-10"
_JOB_ROWS = f"""
SELECT md5(doc_id || '-' || username) AS message_sk, doc_id AS message_id, username AS channel_username,
       CAST(strftime(DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER), '%Y%m%d') AS INTEGER) AS message_date_sk,
       CAST(strftime(DATE '{_DAY}', '%Y%m%d') AS INTEGER) AS scrape_date_sk, text AS message_text
FROM (SELECT *, {O._MAP_CASE} AS username FROM documents) d"""


def _landed(spark, sf_dir):
    import datetime as dt

    from chanlytics.sources.exports import write_landing

    base, day = scratch(spark, "job"), dt.date.fromisoformat(_DAY)
    write_landing(D.export_rows(spark, sf_dir).withColumn("scrape_date", F.lit(day)), base + "/landing")
    return base, day


@register("d1_daily_run", _JOB_ROWS)
def q_daily_run(spark, sf_dir):
    """The daily job over one landed day, its message fact read by name."""
    from chanlytics.plans.daily import Layout, create_tables, run_daily

    base, day = _landed(spark, sf_dir)
    layout = Layout(base + "/warehouse", base + "/landing", landing_format="lines", database="run_" + base.rsplit("-", 1)[-1][:12])
    run_daily(spark, layout, day, mapping=D.CHANNEL_MAP)
    create_tables(spark, layout)  # the run has published its tables; a second call finds them
    return spark.table(f"{layout.database}.fct_messages").select(
        "message_sk", "message_id", "channel_username", "message_date_sk", "scrape_date_sk", "message_text")


@register("i9_staging_view", f"""
SELECT doc_id AS message_id, {O._MAP_CASE} AS channel_username, source AS channel_name,
       DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) AS message_date, DATE '{_DAY}' AS scrape_date, text AS message_text,
       CAST(length(coalesce(text, '')) AS INTEGER) AS message_length, md5(doc_id || '-' || ({O._MAP_CASE})) AS message_sk
FROM documents""")
def q_staging_view(spark, sf_dir):
    """The stored staging view, by name, after a load."""
    from chanlytics.plans.daily import Layout, create_tables

    base, day = _landed(spark, sf_dir)
    layout = Layout(base + "/warehouse", base + "/landing", landing_format="lines", database="stg_" + base.rsplit("-", 1)[-1][:12])
    I.load_landing_day(spark, layout.landing, day, layout.table("raw_messages"), mapping=D.CHANNEL_MAP)
    create_tables(spark, layout)
    return spark.table(f"{layout.database}.stg_messages").select(
        "message_id", "channel_username", "channel_name", "message_date", "scrape_date", "message_text", "message_length", "message_sk")


@register("t1_incremental_ingest", f"""
SELECT doc_id AS message_id, {O._MAP_CASE} AS channel_username, DATE '{_DAY}' AS scrape_date, text AS message_text
FROM documents""")
def q_incremental_ingest(spark, sf_dir):
    """The landed files as a stream; a second start finds nothing new."""
    from chanlytics.streaming import start_landing_ingest

    base, _ = _landed(spark, sf_dir)
    for _ in range(2):
        start_landing_ingest(spark, base + "/landing", base + "/raw", base + "/state",
                             mapping=D.CHANNEL_MAP).awaitTermination()
    return spark.read.parquet(base + "/raw").select("message_id", "channel_username", "scrape_date", "message_text")


@register("t1_sealed_exports", f"""
SELECT doc_id AS message_id, {O._MAP_CASE} AS channel_username, DATE '{_DAY}' AS scrape_date, text AS message_text
FROM documents WHERE CAST(substr(source, 4) AS INTEGER) % 4 <> 1""")
def q_sealed_exports(spark, sf_dir):
    """Exports whose files arrive in three steps, some with a bad line in the last; a stream is started after each.

    Nothing is stored before the seals, and then what the batch loader stores.
    """
    import datetime as dt

    from chanlytics.sources.exports import seal_exports, write_landing
    from chanlytics.streaming import start_landing_ingest

    base, day = scratch(spark, "job"), dt.date.fromisoformat(_DAY)
    rows = D.export_rows(spark, sf_dir).withColumn("scrape_date", F.lit(day))
    landing = base + "/landing"
    seal_exports(rows.where("false"), landing)

    def stream():
        start_landing_ingest(spark, landing, base + "/raw", base + "/state", mapping=D.CHANNEL_MAP).awaitTermination()

    for step in range(2):
        write_landing(rows.where(F.col("message_id") % 2 == step), landing, seal=False, append=True)
        stream()
    late = rows.where(F.substring("channel", 4, 9).cast("int") % 4 == 1).select("channel").distinct()
    (late.select(F.lit('{"message_id": "no number"').alias("value"), F.lit(day).alias("scrape_date"), "channel")
     .write.mode("append").partitionBy("scrape_date", "channel").text(landing))
    stream()
    seal_exports(rows, landing)
    stream()
    return spark.read.parquet(base + "/raw").select("message_id", "channel_username", "scrape_date", "message_text")
