"""Plan shapes that matter at scale (read from the physical plan)."""

import pytest

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    import __spark_entry__ as E
    return E.queries()


def test_the_calendar_is_broadcast(spark, qs):
    p = _plan(qs["m4_fct_messages"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "BroadcastNestedLoopJoin" not in p


def test_no_size_checks(spark, qs):
    """Nothing is counted before a join: no plan limits a side to one partition first."""
    for name in ["m5_fct_image_detections", "s7_j6_new_images", "q6_orphan_detections", "i3_insert_if_absent_lineitem",
                 "i5_load_accounting", "b4_object_mix"]:
        assert "SinglePartition" not in _plan(qs[name](spark, SF_SMALL)).replace("SinglePartition, ENSURE", "x") \
            or "GlobalLimit" not in _plan(qs[name](spark, SF_SMALL)), name


def test_latest_per_key_limits_before_the_shuffle(spark, qs):
    for name in ["w1_latest_event_per_user", "i3_insert_if_absent_lineitem", "e3_normalise_export"]:
        p = _plan(qs[name](spark, SF_SMALL))
        assert "WindowGroupLimit" in p and "Partial" in p, name


def test_dim_channels_aggregates_numbers_first(spark, qs):
    """The messages meet a hash aggregate; only its result is picked by name."""
    p = _plan(qs["m2_dim_channels"](spark, SF_SMALL))
    assert "HashAggregate" in p and "partial_max(message_id" in p


def test_insert_if_absent_shuffles_the_batch_once(spark, qs):
    p = _plan(qs["i3_insert_if_absent_lineitem"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") <= 2  # the batch's first rows and the stored keys
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in p


def test_the_quality_suite_reads_each_table_once(spark, qs):
    p = _plan(qs["q1_q5_q7_quality_suite"](spark, SF_SMALL))
    assert p.count("FileScan parquet") <= 2 * 7  # seven tables; some are read for keys and for counts


def test_the_quality_suite_keeps_cached_inputs(spark):
    from chanlytics.operators import quality as Q

    df = spark.range(5).cache()
    df.count()
    Q.run_checks({"t": df}, [Q.Check("unique", "t", "id")]).collect()
    assert df.storageLevel.useMemory
    df.unpersist()


def test_no_pairwise_joins_anywhere(spark, qs):
    for name, fn in qs.items():
        p = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def _read_schemas(p: str) -> list[str]:
    return [part.split("\n")[0] for part in p.split("ReadSchema: ")[1:]]


def test_reports_prune_columns(spark, qs):
    for s in _read_schemas(_plan(qs["r2_channel_activity"](spark, SF_SMALL))):
        assert "text:" not in s
    for s in _read_schemas(_plan(qs["q6_detections_by_channel"](spark, SF_SMALL))):
        assert "embedding:" not in s


def test_detection_fact_moves_keys_only(spark, qs):
    """Of the messages, the join's shuffle carries the key columns."""
    for s in _read_schemas(_plan(qs["m5_fct_image_detections"](spark, SF_SMALL))):
        assert "n_chars:" not in s


def _moved(df) -> list[str]:
    """The columns of each shuffle and broadcast of a plan."""
    import re

    text = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*?)\]", text)


@pytest.mark.parametrize("literal", [1 << 20, 0])
def test_keyword_counting_moves_no_text(spark, qs, literal):
    """A dictionary inside the row, or joined: what moves are keywords, digests, gaps and sums."""
    from chanlytics.operators import keywords as K
    from chanlytics.sources import driver_tables as D

    raw = D.raw_messages(spark, SF_SMALL)
    kws = spark.createDataFrame([(f"w{i}",) for i in range(50)] + [(f"w{i} x{i}",) for i in range(50)], "keyword string")
    plan = K.keyword_hits(raw, kws, group_cols=["channel_username"], literal_chars=literal)
    moved = _moved(plan)
    assert moved and all(c.strip().split("#")[0] not in ("lt", "text", "message_text", "toks") for m in moved for c in m.split(","))
    if literal:
        assert _plan(plan).count("FileScan parquet") == 1


def test_keyword_reports_move_no_text(spark, qs):
    for name in ["r1_top_products", "r1_top_products_default_keywords", "b2_weekly_keyword_volume", "b5_product_by_channel"]:
        df = qs[name](spark, SF_SMALL)
        assert all("text" not in m and "lt#" not in m for m in _moved(df)), name
        assert _plan(df).count("text:string") == 1, name  # one scan of the texts


def test_phrases_move_counted_candidates_alone(spark):
    """Of a dictionary too long for a literal, what moves of a text is summed phrases, not a row for each of its gaps."""
    from chanlytics.operators import keywords as K

    raw = spark.createDataFrame([(f"a{i} b{i} c d",) for i in range(50)], "message_text string")
    kws = spark.createDataFrame([(f"a{i} b{i}",) for i in range(0, 50, 2)] + [("one",)], "keyword string")
    hits = K.keyword_hits(raw, kws, literal_chars=0)
    names = {c.strip().split("#")[0] for m in _moved(hits) for c in m.split(",")}
    assert names and names <= {"product_name", "sum", "n", "count"}, names
    assert hits.count() == 25
