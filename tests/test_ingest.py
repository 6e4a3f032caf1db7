"""Export scan, per-file quarantine, insert-if-absent, accounting."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from chanlytics import model
from chanlytics.operators import ingest as I

RUN = dt.date(2025, 7, 15)


def _with_scrape_date():
    from pyspark.sql import types as T

    return T.StructType(list(model.EXPORT_SCHEMA.fields) + [T.StructField("scrape_date", T.DateType())])


def _write(base, name, content):
    d = os.path.join(base, RUN.isoformat())
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(content if isinstance(content, str) else json.dumps(content))


def _msg(mid, channel="Chemed", **kw):
    m = {"message_id": mid, "channel": channel, "date": "2025-07-13", "text": "URGENT: insulin",
         "views": 120, "forwards": 2, "has_photo": True, "photo_path": f"data/images/{channel}_{mid}.jpg"}
    m.update(kw)
    return m


def _fixture_files(base):
    _write(base, "ok.json", [_msg(1), _msg(2), _msg(1, views=999)])
    _write(base, "null_text.json", [_msg(3, channel="TikvahPharma", text=None)])
    _write(base, "empty.json", [])
    _write(base, "bad.json", "{not json")
    m = _msg(4)
    del m["views"]
    _write(base, "missing_key.json", [_msg(5), m])
    _write(base, "bad_date.json", [_msg(6, date="nope")])
    _write(base, "long_channel.json", [_msg(7, channel="x" * 256)])
    _write(base, "unmapped.json", [_msg(8, channel="NewChannel")])


def test_load_exports_cases(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing")
    raw = os.path.join(tmp_dir, "raw")
    _fixture_files(base)
    acc, rej = I.load_exports(spark, base, RUN, raw)
    acc = {os.path.basename(r.source_file): (r.recorded, r.skipped) for r in acc.collect()}
    rej = {os.path.basename(r.source_file): r.reason for r in rej.collect()}
    assert acc == {"ok.json": (2, 1), "null_text.json": (1, 0), "empty.json": (0, 0),
                   "unmapped.json": (1, 0)}
    assert rej == {"bad.json": "unparsable", "missing_key.json": "missing_key",
                   "bad_date.json": "bad_date", "long_channel.json": "value_too_long"}
    t = spark.read.parquet(raw)
    rows = {(r.message_id, r.channel_username): r for r in t.collect()}
    assert len(rows) == 4
    assert rows[(1, "@CheMed123")].views == 120          # first write wins
    assert rows[(3, "@tikvahpharma")].message_length == 0  # NULL text -> 0
    assert rows[(8, "NewChannel")].channel_name == "NewChannel"  # fallback mapping
    assert all(r.scrape_date == RUN for r in rows.values())

    # second run of the same files: nothing recorded, all skipped
    acc2, _ = I.load_exports(spark, base, RUN, raw)
    acc2 = {os.path.basename(r.source_file): (r.recorded, r.skipped) for r in acc2.collect()}
    assert acc2["ok.json"] == (0, 3)
    assert acc2["null_text.json"] == (0, 1)
    assert spark.read.parquet(raw).count() == 4


def test_insert_if_absent_pure(spark):
    batch = spark.createDataFrame(
        [(1, "a", 1, "f1"), (1, "a", 0, "f2"), (2, "a", 0, "f1"), (3, "b", 0, "f2")],
        "k long, c string, pos int, source_file string")
    target = spark.createDataFrame([(2, "a")], "k long, c string")
    new = I.new_rows(batch, target, ["k", "c"], [F.col("pos")])
    assert sorted((r.k, r.c, r.pos) for r in new.collect()) == [(1, "a", 0), (3, "b", 0)]
    acc = {r.source_file: (r.recorded, r.skipped) for r in I.load_accounting(batch, new).collect()}
    assert acc == {"f1": (0, 2), "f2": (2, 0)}


def test_insert_if_absent_hot_key(spark):
    """One key holding most of the batch still yields its first row only."""
    rows = [(7, i) for i in range(5000)] + [(k, 0) for k in range(100)]
    batch = spark.createDataFrame(rows, "k long, pos int").repartition(4)
    target = spark.createDataFrame([], "k long")
    new = I.new_rows(batch, target, ["k"], [F.col("pos")])
    assert new.count() == 100
    assert new.filter("k = 7").first().pos == 0


def test_new_images(spark):
    imgs = spark.createDataFrame([("a.jpg",), ("b.jpg",), ("c.jpg",)], "image_path string")
    done = spark.createDataFrame([("a.jpg",), ("a.jpg",)], "image_path string")
    assert sorted(r[0] for r in I.new_images(imgs, done).collect()) == ["b.jpg", "c.jpg"]


def test_landing_roundtrip(spark, tmp_dir):
    from chanlytics.sources.exports import write_landing

    base = os.path.join(tmp_dir, "lines")
    rows = [(1, "Chemed", dt.date(2025, 7, 13), "hi", 1, 0, False, None, RUN)]
    df = spark.createDataFrame(rows, _with_scrape_date())
    write_landing(df, base)
    write_landing(df, base)  # same day again replaces, does not duplicate
    back, rejected = I.validate_landing_rows(I.read_landing_day(spark, base))
    assert rejected.count() == 0
    assert back.count() == 1
    r = back.first()
    assert (r.message_id, r.channel, r.scrape_date) == (1, "Chemed", RUN)


def test_landing_lines_loader(spark, tmp_dir):
    """I1 write -> JSON-lines day -> validate (whole-file reject) -> insert-if-absent."""
    import datetime as dt

    from chanlytics.sources.exports import write_landing

    base = os.path.join(tmp_dir, "lines")
    S = _with_scrape_date()
    good = [(1, "Chemed", dt.date(2025, 7, 13), "hi", 1, 0, False, None, RUN),
            (2, "Chemed", dt.date(2025, 7, 13), None, None, None, True, None, RUN),
            (1, "TikvahPharma", dt.date(2025, 7, 14), "x", 3, 1, False, None, RUN)]
    write_landing(spark.createDataFrame(good, S), base)
    # a second channel folder with one bad line: the whole export is rejected
    bad_dir = os.path.join(base, f"scrape_date={RUN.isoformat()}", "channel=Lobelia4Cosmetics")
    os.makedirs(bad_dir)
    with open(os.path.join(bad_dir, "part-0.json"), "w") as f:
        f.write(json.dumps(_msg(5)) + "\n")
    with open(os.path.join(bad_dir, "part-1.json"), "w") as f:
        f.write(json.dumps(_msg(6, date="nope")) + "\n")
    raw = os.path.join(tmp_dir, "raw")
    acc, rej = I.load_landing_day(spark, base, RUN, raw)
    assert sum(r.recorded for r in acc.collect()) == 3
    assert [r.reason for r in rej.collect()] == ["bad_date"]
    got = {(r.message_id, r.channel_username, r.message_length) for r in spark.read.parquet(raw).collect()}
    assert got == {(1, "@CheMed123", 2), (2, "@CheMed123", 0), (1, "@tikvahpharma", 1)}
    acc2, _ = I.load_landing_day(spark, base, RUN, raw)
    assert sum(r.recorded for r in acc2.collect()) == 0
    assert sum(r.skipped for r in acc2.collect()) == 3


def test_rules_are_one_for_both_layouts(spark, tmp_dir):
    """Names like numbers, missing keys, text behind the value, quotes in the mapping, first write wins."""
    from chanlytics.sources.exports import write_landing

    mapping = {"007": "O'Neil \\ sons", "it's": "x"}
    records = [_msg(1, "007", text="zzz first"), _msg(1, "007", text="aaa second"), _msg(2, "007", text=None)]
    lines, arrays = os.path.join(tmp_dir, "lines"), os.path.join(tmp_dir, "arrays")
    rows = [(r["message_id"], r["channel"], dt.date(2025, 7, 13), r["text"], 120, 2, True, None, RUN, i)
            for i, r in enumerate(records)]
    from pyspark.sql import types as T
    schema = T.StructType([*_with_scrape_date().fields, T.StructField("source_pos", T.LongType())])
    write_landing(spark.createDataFrame(rows, schema).repartition(3), lines)
    _write(arrays, "007.json", records)
    cut = _msg(4, "cut")
    del cut["photo_path"]
    for name, line in {"cut": json.dumps(cut), "tail": json.dumps(_msg(5, "tail")) + " junk",
                       "two": json.dumps(_msg(6, "two")) + "," + json.dumps(_msg(7, "two")), "no": "{"}.items():
        folder = os.path.join(lines, f"scrape_date={RUN}", f"channel={name}")
        os.makedirs(folder)
        with open(os.path.join(folder, "part-0.json"), "w") as f:
            f.write(line + "\n")
        _write(arrays, f"{name}.json", f"[{line}]" if name != "tail" else f"[{json.dumps(_msg(5, 'tail'))}] junk")
    _write(arrays, "two.json", f"[{json.dumps(_msg(6, 'two'))}],[]")
    got = {}
    for name, load, base in (("lines", I.load_landing_day, lines), ("arrays", I.load_exports, arrays)):
        acc, rejected = load(spark, base, RUN, os.path.join(tmp_dir, name + "_raw"), mapping=mapping)
        stored = spark.read.parquet(os.path.join(tmp_dir, name + "_raw")).collect()
        got[name] = (sorted((r.message_id, r.channel_name, r.channel_username, r.message_text) for r in stored if r.message_text)
                     , sorted(r.reason for r in rejected.collect()), sorted((r.recorded, r.skipped) for r in acc.collect()))
    assert got["lines"] == got["arrays"] == (
        [(1, "007", "O'Neil \\ sons", "zzz first")], ["missing_key"] + ["unparsable"] * 3, [(2, 1)])


def test_a_day_without_a_folder_loads_nothing(spark, tmp_dir):
    for k, load in enumerate((I.load_exports, I.load_landing_day)):
        acc, rejected = load(spark, os.path.join(tmp_dir, "none"), RUN, os.path.join(tmp_dir, f"raw{k}"))
        assert acc.collect() == [] and rejected.collect() == []


def test_accounting_of_reruns_is_kept(spark, tmp_dir):
    _fixture_files(os.path.join(tmp_dir, "landing"))
    path = os.path.join(tmp_dir, "accounting")
    for _ in range(2):
        I.load_exports(spark, os.path.join(tmp_dir, "landing"), RUN, os.path.join(tmp_dir, "raw"), accounting_path=path)
    runs = spark.read.parquet(path).groupBy("run_date", "run_id").agg(F.sum("recorded").alias("n")).collect()
    assert sorted(r.n for r in runs) == [0, 4] and {r.run_date for r in runs} == {RUN}


def test_the_batch_is_evaluated_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    batch = spark.range(1000).selectExpr("id AS k").mapInPandas(count, "k long")
    target = spark.range(100).selectExpr("id * 5 AS k")
    assert I.new_rows(batch, target, ["k"], [F.col("k")]).count() == 900
    assert seen.value == 1000


def test_array_files_are_bounded_and_judged_whole(spark):
    from chanlytics.sources.exports import array_files, parse_export_files

    rows = [(f"2025-07-13/{c}.json", 3 * i, i, None if c == "bad" and i == 240 else "Chemed", dt.date(2025, 7, 13), "t")
            for c in ("good", "bad") for i in range(250)]
    df = spark.createDataFrame(rows, "source_file string, source_pos long, message_id long, channel string, date date, text string")
    export = df.select("*", F.lit(1).alias("views"), F.lit(2).alias("forwards"), F.lit(True).alias("has_photo"),
                       F.lit(None).cast("string").alias("photo_path"))
    files = array_files(export)
    assert sorted(len(json.loads(r.content)) for r in files.collect()) == [50, 50, 100, 100, 100, 100]
    parts = I.validate_export_files(parse_export_files(files))
    assert {tuple(r) for r in I.export_verdicts(parts).collect()} == {
        ("2025-07-13/good.json", 250, None), ("2025-07-13/bad.json", 250, "null_channel")}
    got = I.export_records(I.accepted_parts(parts)).collect()
    assert sorted((r.source_file, r.source_pos, r.message_id) for r in got) == [
        ("2025-07-13/good.json", i, i) for i in range(250)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_of_few_exports_are_not_dealt_by_export(spark, tmp_dir):
    """Rejected exports are joined by their real size: the lines, of a few exports at times, stay in their tasks."""
    lines = [(json.dumps({**{k: None for k in model.EXPORT_KEYS}, "message_id": i, "source_pos": i}), RUN, ch)
             for i in range(20) for ch in ("a", "b")] + [("no json", RUN, "b"), ("no json", RUN, None)]
    rows = spark.createDataFrame(lines, I.LINES_SCHEMA)
    ok, bad = I.validate_landing_rows(rows, {})
    assert "hashpartitioning(source_file" not in _plan(ok)
    assert sorted(r.message_id for r in ok.collect()) == list(range(20))
    # a line of no channel is of the export <date>
    assert sorted((r.source_file, r.reason, r.n_bad_records) for r in bad.collect()) == [
        (RUN.isoformat(), "unparsable", 1), (f"{RUN}/b", "unparsable", 1)]


def test_large_channel_day_is_dealt_out(spark, tmp_dir, monkeypatch):
    """One task's rows of a large channel-day have several keys for the landing's shuffle; small ones have one."""
    from chanlytics.sources import exports as E

    monkeypatch.setattr(E, "CELL_BYTES", 2000)
    schema = ("message_id long, channel string, date date, text string, views int, forwards int, has_photo boolean, "
              "photo_path string, scrape_date date, source_pos long")
    rows = [(i, ch, RUN, None if i % 7 == 0 else "x" * 40, 1, 1, False, None, RUN, i)
            for ch, n in (("big", 200), ("small", 5), (None, 200)) for i in range(n)]
    df = spark.createDataFrame(rows + rows[:1], schema).coalesce(1)
    cells = {r.channel: r.n for r in E._in_cells(df).groupBy("channel").agg(F.countDistinct("__cell").alias("n")).collect()}
    assert cells["big"] > 10 and cells[None] > 10 and cells["small"] == 1
    base = os.path.join(tmp_dir, "landing")
    E.write_landing(df, base)
    back = spark.read.schema("message_id long, text string, scrape_date date, channel string").json(base)
    named = back.where("channel is not null").select("message_id", "channel", "text")
    assert sorted(map(tuple, named.collect()), key=str) == sorted([(r[0], r[1], r[3]) for r in rows + rows[:1] if r[1]], key=str)
    assert back.count() == len(rows) + 1
