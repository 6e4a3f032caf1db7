"""Insert-if-absent on a stored table: what is read, what moves, and reruns."""

import datetime as dt
import os

from pyspark.sql import functions as F

from chanlytics import model
from chanlytics.operators import ingest as I

SCHEMA = model.RAW_MESSAGES_SCHEMA
KEYS = model.RAW_MESSAGES_KEY
ORDER = ["views"]


def _batch(spark, ids, views=0, channel="@c"):
    rows = [(i, "c", channel, dt.date(2024, 4, 1), dt.date(2024, 4, 1), f"t{i}", 1, views, 0, False, None) for i in ids]
    return spark.createDataFrame(rows, SCHEMA)


def _table(spark, path, buckets=3, ids=100):
    return I.KeyedTable(spark, path, SCHEMA, tuple(KEYS), I.id_block("message_id", ids), buckets)


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_a_small_batch_reads_a_fraction_and_moves_no_stored_key(spark, tmp_dir):
    t = _table(spark, os.path.join(tmp_dir, "t"))
    t.append(_batch(spark, range(2000)))
    batch = _batch(spark, range(1985, 2005))
    new = t.absent(batch, ORDER)
    plan = _plan(new)
    assert sorted(r.message_id for r in new.collect()) == list(range(2000, 2005))
    tree = plan[:plan.index("\n\n\n")].splitlines()
    assert sum("Scan parquet" in line for line in tree) == 1
    assert "key_block" in plan.split("PartitionFilters: [")[1][:90]
    stored_side = tree[max(k for k, line in enumerate(tree) if ":" in line) + 1:]  # the join's right child
    assert any("Scan parquet" in line for line in stored_side) and not any("Exchange" in line for line in stored_side)
    assert "Bucketed: true" in plan
    read, stored = len(t.stored_keys([19, 20]).inputFiles()), len(t.rows().inputFiles())
    assert 0 < read <= stored / 10


def test_reruns_other_sessions_and_repeated_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    for views in (1, 2):
        both = _batch(spark, [1, 2, 3], views).unionByName(_batch(spark, [3, 250_000], views + 10))
        I.append_if_absent(spark, both, path, SCHEMA, KEYS, ORDER)
    got = sorted((r.message_id, r.views) for r in I.read_table(spark, path, SCHEMA).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (250_000, 11)]
    # a catalog that does not know the table finds its rows and its buckets in the folder
    t = I.keyed_table(spark, path, SCHEMA, KEYS, buckets=99)
    spark.sql(f"DROP TABLE {t.name}")
    assert t.ensure() == 4
    new = I.append_if_absent(spark, _batch(spark, [2, 4]), path, SCHEMA, KEYS, ORDER)
    assert [r.message_id for r in new.collect()] == [4]
    assert I.read_table(spark, path, SCHEMA).count() == 5


def test_odd_keys(spark, tmp_dir):
    """Negative, huge and NULL ids have blocks too; a NULL key is never stored as equal, as in SQL."""
    path = os.path.join(tmp_dir, "t")
    ids = [-5, 0, 2 ** 62, -(2 ** 62), None]
    for _ in range(2):
        I.append_if_absent(spark, _batch(spark, ids), path, SCHEMA, KEYS, ORDER)
    got = [r.message_id for r in I.read_table(spark, path, SCHEMA).collect()]
    assert sorted(x for x in got if x is not None) == sorted(x for x in ids if x is not None)
    assert got.count(None) == 2
    assert I.append_if_absent(spark, _batch(spark, []), path, SCHEMA, KEYS, ORDER).count() == 0


def test_a_plain_table_is_refused(spark, tmp_dir):
    import pytest

    path = os.path.join(tmp_dir, "plain")
    _batch(spark, [1]).write.parquet(path)
    with pytest.raises(ValueError, match="not stored by key"):
        I.append_if_absent(spark, _batch(spark, [1]), path, SCHEMA, KEYS, ORDER)


def _stored_files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-") and "_buckets" not in d]


def test_ids_far_apart_share_folders(spark, tmp_dir, monkeypatch):
    """A first batch of few rows in many blocks makes no file for each of them; what is stored is found all the same."""
    monkeypatch.setattr("chanlytics.operators.keyed.FILES", 24, raising=False)
    path = os.path.join(tmp_dir, "t")
    ids = [k * 10_000_000 + i for k in range(40) for i in range(3)]
    I.append_if_absent(spark, _batch(spark, ids), path, SCHEMA, KEYS, ORDER)
    assert 0 < len(_stored_files(path)) <= 24 * spark.sparkContext.defaultParallelism
    # a stride of the ids does not bring them into one folder
    assert 4 <= len([d for d in os.listdir(path) if d.startswith("key_block=")]) <= 6
    more = ids[::2] + [x + 50 for x in ids[:9]] + [None, -7]
    spark.sql(f"DROP TABLE {I.keyed_table(spark, path, SCHEMA, KEYS).name}")  # the folder knows its blocks
    new = I.append_if_absent(spark, _batch(spark, more, views=5), path, SCHEMA, KEYS, ORDER)
    assert sorted(r.message_id or 0 for r in new.collect()) == sorted([x + 50 for x in ids[:9]] + [0, -7])
    got = {r.message_id: r.views for r in I.read_table(spark, path, SCHEMA).collect()}
    assert len(got) == len(ids) + 11 and all(got[x] == 0 for x in ids)


def test_a_dense_batch_keeps_its_blocks(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    t = I.keyed_table(spark, path, SCHEMA, KEYS)
    I.append_if_absent(spark, _batch(spark, [5, 100_005, 2_000_005]), path, SCHEMA, KEYS, ORDER)
    assert sorted(d for d in os.listdir(path) if d.startswith("key_block=")) == ["key_block=0", "key_block=1", "key_block=20"]
    # rows allow as many files as it takes
    assert t._layout(10 ** 9, 512) == (4, 512) and t._layout(10, 3) == (4, 512) and t._layout(0, 0) == (4, 512)
    assert t._layout(10_000, 600)[1] == 512 and I.keyed_table(spark, path, SCHEMA, KEYS, 200)._layout(600_000, 60) == (200, 10)


def test_a_table_of_before_blocks_were_kept(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(1).selectExpr("'4'").coalesce(1).write.text(f"{path}/_buckets")
    t = I.keyed_table(spark, path, SCHEMA, KEYS)
    assert t._stored_layout(10, 500) == (4, 512)
    I.append_if_absent(spark, _batch(spark, [51_100_000]), path, SCHEMA, KEYS, ORDER)
    assert [d for d in os.listdir(path) if d.startswith("key_block=")] == ["key_block=511"]


def test_bloom_filters_have_the_size_of_their_keys(spark, tmp_dir):
    """A file of a few hundred keys has no filter of 1 MB, and a lookup by key still finds its row."""
    import pyarrow.parquet as pq

    path = os.path.join(tmp_dir, "t")
    I.append_if_absent(spark, _batch(spark, range(0, 4000, 3)), path, SCHEMA, KEYS, ORDER)
    files = _stored_files(path)
    assert files and max(os.path.getsize(f) for f in files) < 200_000
    for f in files:  # beside the columns and the footer, the filters of the keys
        m = pq.ParquetFile(f).metadata
        columns = sum(m.row_group(0).column(i).total_compressed_size for i in range(m.num_columns))
        assert os.path.getsize(f) - columns - m.serialized_size > 200
    assert [r.message_id for r in I.read_table(spark, path, SCHEMA).where("message_id in (3, 4, 3999)").orderBy("message_id").collect()] == [3, 3999]


def test_blocks_of_named_ids(spark):
    df = spark.createDataFrame([("Che_med", "Chemed_250001.jpg_pill_0"), ("x", "a.jpg"), ("x", "data/images/Chemed_250001_2.jpg")],
                               "c string, detection_id string")
    got = [r[0] for r in df.select(F.expr(I.KEY_BLOCKS["detection_id"])).collect()]
    assert all(0 <= b < 512 for b in got) and got[0] == 2 and got[1] == 0
