"""Registered queries of the operators: thin calls over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlytics.llm import common as C
from chanlytics.llm import (decontaminate, licenses, near_dedup, periodic, pieces, pii, quality, sharding, spelling, substring_dedup,
                            url_filter, vamana)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, batch_rows: int = C.BATCH_ROWS):
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            C.prepare(spark, batch_rows)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


# documents dealt into blocks compress better from larger batches
@query("op1_lm_scoring", batch_rows=10_000)
def lm_scoring(spark, sf_dir):
    from chanlytics.llm.ngram_lm import score_texts

    return score_texts(C.read_table(spark, sf_dir, "documents"), C.fold_of("doc_id") == 1)


@query("op6_substring_dedup", substring_dedup.ORACLE, batch_rows=10_000)
def substring_dedup_query(spark, sf_dir):
    return substring_dedup.remove_repeats(C.read_table(spark, sf_dir, "documents"), digest=True)


@query("op5_decontamination", decontaminate.ORACLE)
def decontamination(spark, sf_dir):
    return decontaminate.report(C.read_table(spark, sf_dir, "documents"), C.read_table(spark, sf_dir, "benchmark"))


@query("op3_near_dedup")
def near_duplicates(spark, sf_dir):
    """One row per document: its class, and how many documents the class has."""
    found = near_dedup.classes(C.read_table(spark, sf_dir, "documents"))
    sizes = found.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    # a class without any id has no name; its rows count for themselves
    return found.join(sizes, "class_id", "left").select("doc_id", "class_id", F.coalesce("class_size", F.lit(1)).alias("class_size"))


@query("op8_quality")
def quality_scores(spark, sf_dir):
    return quality.scored(C.read_table(spark, sf_dir, "documents"), C.read_table(spark, sf_dir, "labels"))


@query("op9_pii")
def personal_data(spark, sf_dir):
    return pii.report(C.read_table(spark, sf_dir, "documents"))


@query("op10_license_scan", licenses.ORACLE)
def license_scan(spark, sf_dir):
    return licenses.report(C.read_table(spark, sf_dir, "documents"))


@query("op4_sharding", sharding.ORACLE)
def shard_placement(spark, sf_dir):
    return sharding.assign(C.read_table(spark, sf_dir, "documents").select("doc_id", "source"), F.col("doc_id"))


@query("op7_nearest_neighbours")
def nearest_neighbours(spark, sf_dir):
    return vamana.search_table(C.read_table(spark, sf_dir, "embeddings"))


@query("op2_sentencepiece")
def sentence_pieces(spark, sf_dir):
    return pieces.report(C.read_table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def periodic_runs(spark, sf_dir):
    return periodic.report(C.read_table(spark, sf_dir, "documents"))


@query("op12_url_filter", url_filter.ORACLE)
def url_verdicts(spark, sf_dir):
    return url_filter.report(C.read_table(spark, sf_dir, "pages"))


@query("op13_spelling_variants")
def spelling_variants(spark, sf_dir):
    return spelling.report(C.read_table(spark, sf_dir, "documents"))
