"""Declarative data-quality checks (Q1-Q7) run as one DataFrame job.

A check names a table, a column and a kind:

* ``not_null``      failures = rows where the column is NULL
* ``unique``        failures = distinct non-NULL values seen more than once
* ``relationships`` failures = child rows whose non-NULL key has no parent
* ``expression``    failures = rows matching a violation predicate

Each table is read once; see ``run_checks``.
The result has one row per check:
``(test_name, table_name, column_name, failures, passed)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str | None = None
    to_table: str | None = None
    to_column: str | None = None
    predicate: str | None = None
    name: str | None = None

    @property
    def test_name(self) -> str:
        if self.name:
            return self.name
        if self.kind == "relationships":
            return f"relationships:{self.table}.{self.column}->{self.to_table}.{self.to_column}"
        return f"{self.kind}:{self.table}.{self.column}"


# ---------------------------------------------------------------------------
# The tests declared by the reference model, per table.
# ---------------------------------------------------------------------------
DECLARED_TESTS = {
    "raw_messages": {
        "not_null": ["message_id", "channel_name", "channel_username", "scrape_date", "message_date"],
    },
    "raw_image_detections": {
        "not_null": ["detection_id", "message_id", "channel_username", "detected_object_class",
                     "confidence_score", "detection_timestamp"],
        "unique": ["detection_id"],
    },
    "stg_messages": {
        "not_null": ["message_id", "channel_username", "message_sk", "message_date", "scrape_date"],
        "unique": ["message_sk"],
    },
    "dim_channels": {
        "not_null": ["channel_sk", "channel_username", "channel_name"],
        "unique": ["channel_sk", "channel_username"],
    },
    "dim_dates": {
        "not_null": ["date_sk", "full_date"],
        "unique": ["date_sk", "full_date"],
    },
    "fct_messages": {
        "not_null": ["message_sk", "message_id", "channel_sk", "channel_username",
                     "message_date_sk", "scrape_date_sk"],
        "unique": ["message_sk"],
        "relationships": [
            ("message_sk", "stg_messages", "message_sk"),
            ("channel_sk", "dim_channels", "channel_sk"),
            ("message_date_sk", "dim_dates", "date_sk"),
            ("scrape_date_sk", "dim_dates", "date_sk"),
        ],
    },
    "fct_image_detections": {
        "not_null": ["image_detection_sk", "message_sk", "detected_object_class",
                     "confidence_score", "detection_timestamp"],
        "unique": ["image_detection_sk"],
        "relationships": [("message_sk", "fct_messages", "message_sk")],
    },
}

# Singular and documented checks (violation predicates).
PHOTO_FLAG_WITHOUT_PHOTO = Check(
    "expression", "stg_messages", "has_photo",
    predicate="has_photo = false AND photo_path IS NOT NULL",
    name="custom:has_photo_false_with_photo_path")
PHOTO_WITHOUT_PATH = Check(
    "expression", "stg_messages", "photo_path",
    predicate="has_photo = true AND photo_path IS NULL",
    name="custom:has_photo_true_without_photo_path")
CONFIDENCE_RANGE = Check(
    "expression", "fct_image_detections", "confidence_score",
    predicate="NOT (confidence_score BETWEEN 0 AND 1)",
    name="custom:confidence_score_between_0_and_1")


def declared_checks() -> list[Check]:
    out: list[Check] = []
    for table, kinds in DECLARED_TESTS.items():
        for col in kinds.get("not_null", []):
            out.append(Check("not_null", table, col))
        for col in kinds.get("unique", []):
            out.append(Check("unique", table, col))
        for col, to_t, to_c in kinds.get("relationships", []):
            out.append(Check("relationships", table, col, to_t, to_c))
    return out


def all_checks() -> list[Check]:
    """The 45 declared generic tests, the singular test and the two documented ones."""
    return declared_checks() + [PHOTO_FLAG_WITHOUT_PHOTO, PHOTO_WITHOUT_PATH, CONFIDENCE_RANGE]


def run_checks(tables: dict[str, DataFrame], checks: list[Check] | None = None) -> DataFrame:
    """One row per check with its failure count and pass flag.

    Each table is read once.  Its predicate checks (not_null, expression)
    become counts of a single aggregate.  Columns that relationships connect
    share a domain, and a key column sends its keys once, as 128 bits of
    hashes of their text, whatever the number of unique and relationship
    checks that ask for it.  One aggregate per (domain, key) counts each
    column's rows, partial in every task, so a key shared by a third of a
    fact (a big channel, a busy day) costs one row per task; all checks are
    read from these counts.
    """
    checks = all_checks() if checks is None else checks
    for c in checks:
        if c.kind not in ("not_null", "expression", "unique", "relationships"):
            raise ValueError(f"unknown check kind {c.kind}")
    number = {id(c): i for i, c in enumerate(checks)}
    spark = next(iter(tables.values())).sparkSession
    found: DataFrame | None = None
    keys: DataFrame | None = None
    slots = _key_slots(checks)
    width = 1 + max((slot for _, slot in slots.values()), default=0)
    for name in sorted({c.table for c in checks} | {c.to_table for c in checks if c.to_table}):
        rules = [c for c in checks if c.table == name and c.kind in ("not_null", "expression")]
        if rules:
            counts = tables[name].agg(*[F.count(F.when(_violation(c), 1)).alias(f"f{number[id(c)]}") for c in rules])
            part = _as_rows(counts, [number[id(c)] for c in rules])
            found = part if found is None else found.unionAll(part)
        own = [(column, *place) for (table, column), place in slots.items() if table == name]
        if own:
            entries = F.array(*[_key_entry(column, domain, slot, width) for column, domain, slot in own])
            part = tables[name].select(F.explode(entries).alias("x")).select("x.*").where("high is not null")
            keys = part if keys is None else keys.unionAll(part)
    if keys is not None:
        per_key = keys.groupBy("domain", "high", "low").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(width)])
        failures = []
        for c in checks:
            if c.kind not in ("unique", "relationships"):
                continue
            domain, slot = slots[c.table, c.column]
            here = F.col("domain") == domain
            if c.kind == "unique":
                bad = F.when(here & (F.col(f"n{slot}") > 1), 1)
            else:
                bad = F.when(here & (F.col(f"n{slots[c.to_table, c.to_column][1]}") == 0), F.col(f"n{slot}"))
            failures.append((number[id(c)], F.sum(bad).cast("long")))
        part = _as_rows(per_key.agg(*[total.alias(f"f{i}") for i, total in failures]), [i for i, _ in failures])
        found = part if found is None else found.unionAll(part)
    listed = spark.createDataFrame(
        [(i, c.test_name, c.table, c.column) for i, c in enumerate(checks)],
        "id int, test_name string, table_name string, column_name string")
    failures = F.coalesce("failures", F.lit(0)).cast("long")
    if found is None:
        found = listed.select("id", F.lit(0).cast("long").alias("failures"))
    # one row for each check on either side
    return listed.join(F.broadcast(found), "id", "left").select(
        "test_name", "table_name", "column_name", failures.alias("failures"), (failures == 0).alias("passed"))


def _key_slots(checks: list[Check]) -> dict[tuple[str, str], tuple[int, int]]:
    """(domain, slot) of each key column: columns that relationships connect are one domain."""
    group: dict[tuple[str, str], set] = {}
    for c in checks:
        if c.kind in ("unique", "relationships"):
            ends = [(c.table, c.column)] + ([(c.to_table, c.to_column)] if c.kind == "relationships" else [])
            merged = set(ends).union(*[group.get(e, set()) for e in ends])
            group.update({e: merged for e in merged})
    domains = sorted({tuple(sorted(g)) for g in group.values()})
    return {column: (d, s) for d, domain in enumerate(domains) for s, column in enumerate(domain)}


def _key_entry(column: str, domain: int, slot: int, width: int):
    """A row's key in one column: the domain, 128 bits for the key (NULL for none), 1 in the column's own count."""
    key = F.col(column).cast("string")
    counts = [F.lit(int(i == slot)).cast("long").alias(f"n{i}") for i in range(width)]
    return F.struct(F.lit(domain).alias("domain"), F.when(key.isNotNull(), F.xxhash64(key)).alias("high"),
                    F.when(key.isNotNull(), F.xxhash64(F.lit(1), key)).alias("low"), *counts)


def _as_rows(counts: DataFrame, ids: list[int]) -> DataFrame:
    """One row of counts f<id> as (id, failures) rows."""
    rows = F.array(*[F.struct(F.lit(i).alias("id"), F.col(f"f{i}").alias("failures")) for i in ids])
    return counts.select(F.explode(rows).alias("x")).select("x.id", "x.failures")


def _violation(c: Check):
    return F.col(c.column).isNull() if c.kind == "not_null" else F.expr(c.predicate)


def checks_sql(checks: list[Check] | None = None, prefix: str = "") -> str:
    """The same checks as one SQL UNION over tables named like ``Check.table``, with a prefix."""
    checks = all_checks() if checks is None else checks
    sel = []
    for c in checks:
        head = (f"SELECT '{c.test_name}' AS test_name, '{c.table}' AS table_name, "
                f"'{c.column}' AS column_name, ")
        if c.kind == "not_null":
            body = f"CAST(count(*) AS BIGINT) AS failures FROM {prefix}{c.table} WHERE {c.column} IS NULL"
        elif c.kind == "unique":
            body = (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} FROM {prefix}{c.table} "
                    f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1) u")
        elif c.kind == "relationships":
            body = (f"CAST(count(*) AS BIGINT) AS failures FROM {prefix}{c.table} ch "
                    f"LEFT JOIN (SELECT DISTINCT {c.to_column} AS k FROM {prefix}{c.to_table}) p "
                    f"ON ch.{c.column} = p.k WHERE ch.{c.column} IS NOT NULL AND p.k IS NULL")
        else:
            body = f"CAST(count(*) AS BIGINT) AS failures FROM {prefix}{c.table} WHERE {c.predicate}"
        sel.append(head + body)
    return ("SELECT test_name, table_name, column_name, failures, failures = 0 AS passed FROM (\n"
            + "\nUNION ALL\n".join(sel) + "\n) q")


def model_tables(marts) -> dict[str, DataFrame]:
    """The check targets of a built model (``plans.marts.Marts``)."""
    return {
        "raw_messages": marts.raw_messages,
        "raw_image_detections": marts.raw_detections,
        "stg_messages": marts.staging,
        "dim_channels": marts.dim_channels,
        "dim_dates": marts.dim_dates,
        "fct_messages": marts.fct_messages,
        "fct_image_detections": marts.fct_image_detections,
    }


def detection_health(detections: DataFrame, messages: DataFrame,
                     sample_size: int = 5) -> dict[str, DataFrame]:
    """Q6: the detection health report as five DataFrames.

    total, per channel, duplicate ids, a sample (first rows by id) and
    detections whose (message_id, channel_username) has no message.
    """
    sample_cols = ["detection_id", "message_id", "channel_username", "image_path",
                   "detected_object_class", "confidence_score"]
    return {
        "total": detections.agg(F.count(F.lit(1)).alias("total_detections")),
        "by_channel": detections.groupBy("channel_username")
                                .agg(F.count(F.lit(1)).alias("detections")),
        "duplicates": detections.groupBy("detection_id").agg(F.count(F.lit(1)).alias("n"))
                                .filter(F.col("n") > 1),
        "sample": detections.select(*sample_cols).orderBy("detection_id").limit(sample_size),
        "orphans": detections.select("message_id", "channel_username").join(
            messages.select("message_id", "channel_username"), ["message_id", "channel_username"], "left_anti"),
    }
