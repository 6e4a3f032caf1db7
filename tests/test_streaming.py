"""File streams feed the batch operators; results equal the batch job."""

import datetime as dt
import json
import os

import numpy as np
import pandas as pd
import pytest

from chanlytics.operators import ingest as I
from chanlytics.operators.detect import Scorer
from chanlytics.streaming import start_export_ingest, start_image_scoring


def _write(base, date, name, rows):
    d = os.path.join(base, date)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        json.dump(rows, f)


def _m(i, ch="Chemed", views=1):
    return {"message_id": i, "channel": ch, "date": "2025-07-10", "text": f"t{i}", "views": views,
            "forwards": 0, "has_photo": False, "photo_path": None}


def test_export_stream_equals_batch(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing")
    _write(base, "2025-07-14", "Chemed.json", [_m(1), _m(2)])
    _write(base, "2025-07-14", "bad.json", [{"message_id": 9}])
    raw_s = os.path.join(tmp_dir, "raw_stream")
    q = start_export_ingest(spark, base, raw_s, os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    # a second day arrives; one message repeats with other views (first wins)
    _write(base, "2025-07-15", "Chemed.json", [_m(2, views=50), _m(3)])
    q = start_export_ingest(spark, base, raw_s, os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    got = {(r.message_id, r.views, r.scrape_date) for r in spark.read.parquet(raw_s).collect()}
    assert got == {(1, 1, dt.date(2025, 7, 14)), (2, 1, dt.date(2025, 7, 14)),
                   (3, 1, dt.date(2025, 7, 15))}
    # batch loader over the same folders gives the same rows (scrape dates aside)
    raw_b = os.path.join(tmp_dir, "raw_batch")
    I.load_exports(spark, base, dt.date(2025, 7, 14), raw_b)
    I.load_exports(spark, base, dt.date(2025, 7, 15), raw_b)
    got_b = {(r.message_id, r.views, r.scrape_date) for r in spark.read.parquet(raw_b).collect()}
    assert got_b == got


class LengthScorer(Scorer):
    """Test detector: one box per 100 bytes of the image, class 'blob'."""

    class_names = ["blob"]
    token = "length-scorer"

    def predict(self, payloads: pd.Series):
        return [[(0, 0.5)] * (len(p) // 100) for p in payloads]


def test_image_stream(spark, tmp_dir):
    img = os.path.join(tmp_dir, "images")
    os.makedirs(img)
    for name, size in [("Chemed_97.jpg", 250), ("Chemed_98_20230101.JPG", 120), ("Chemed_99.png", 50),
                       ("notes.txt", 300), ("Chemed.jpg", 300), ("Unknown_5.jpg", 300),
                       ("Chemed_abc.jpg", 300), ("Chemed_97.png", 100)]:
        with open(os.path.join(img, name), "wb") as f:
            f.write(np.zeros(size, dtype=np.uint8).tobytes())
    det = os.path.join(tmp_dir, "det")
    log = os.path.join(tmp_dir, "log")
    q = start_image_scoring(spark, img, LengthScorer(), det, os.path.join(tmp_dir, "ck"), log)
    q.awaitTermination(120)
    rows = sorted((r.detection_id, r.message_id, r.channel_username, r.image_path)
                  for r in spark.read.parquet(det).collect())
    assert rows == [
        ("Chemed_97.jpg_blob_0", 97, "@CheMed123", "data/images/Chemed_97.jpg"),
        ("Chemed_97.jpg_blob_1", 97, "@CheMed123", "data/images/Chemed_97.jpg"),
        ("Chemed_97.png_blob_0", 97, "@CheMed123", "data/images/Chemed_97.png"),  # same stem, both kept
        ("Chemed_98_20230101.JPG_blob_0", 98, "@CheMed123", "data/images/Chemed_98_20230101.JPG"),
    ]
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert all(abs(now - r.detection_timestamp) < dt.timedelta(minutes=10) for r in spark.read.parquet(det).collect())
    logged = {r.image_path: r.n_boxes for r in spark.read.parquet(log).collect()}
    assert logged["data/images/Chemed_99.png"] == 0   # zero-box image remembered
    assert "data/images/Unknown_5.jpg" not in logged   # unmapped: never scored


def test_batch_detection_skips_processed_images(spark, tmp_dir):
    """J6 + E2: a second run scores nothing that is stored or logged."""
    from chanlytics.operators.detect import list_images, read_images, run_detection

    img = os.path.join(tmp_dir, "images")
    os.makedirs(img)
    for name, size in [("Chemed_1.jpg", 250), ("Chemed_2.jpg", 10)]:
        with open(os.path.join(img, name), "wb") as f:
            f.write(np.zeros(size, dtype=np.uint8).tobytes())
    det, log = os.path.join(tmp_dir, "det"), os.path.join(tmp_dir, "log")
    first = run_detection(spark, read_images(spark, img), LengthScorer(), det, dt.datetime(2025, 7, 15), log)
    assert first.scored.count() == 2
    for images in (read_images(spark, img), list_images(spark, img)):
        again = run_detection(spark, images, LengthScorer(), det, dt.datetime(2025, 7, 16), log)
        assert again.scored.count() == 0
    assert spark.read.parquet(det).count() == 2


def test_only_new_images_are_opened(spark, tmp_dir):
    """A processed image, one of an unknown channel and one with a bad name are larger than a read may be."""
    from chanlytics.operators.detect import list_images, run_detection

    img = os.path.join(tmp_dir, "images")
    os.makedirs(img)

    def put(name, size):
        with open(os.path.join(img, name), "wb") as f:
            f.write(bytes(size))
    for name in ("Chemed_1.jpg", "Chemed_2.jpg", "Chemed_2_[a]*.jpg"):
        put(name, 250)
    det, log = os.path.join(tmp_dir, "det"), os.path.join(tmp_dir, "log")
    run_detection(spark, list_images(spark, img), LengthScorer(), det, dt.datetime(2025, 7, 15), log)
    for name in ("Chemed_1.jpg", "Chemed_2.jpg", "Unknown_5.jpg", "Chemed.jpg", "Chemed_9.txt"):
        put(name, 5000)
    for k in range(7):
        put(f"Chemed_{10 + k}.png", 100)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        again = run_detection(spark, list_images(spark, img), LengthScorer(), det, dt.datetime(2025, 7, 16), log, batch_paths=2)
        assert again.scored.count() == 7
        assert {r.reason for r in again.rejects.collect()} == {"unmapped_channel", "bad_name"}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    ids = sorted(r.detection_id for r in spark.read.parquet(det).collect())
    assert len(ids) == 13 and "Chemed_2_[a]*.jpg_blob_1" in ids and "Chemed_16.png_blob_0" in ids


def test_quarantine_rewrite_is_idempotent(spark, tmp_dir):
    import datetime as dt

    from chanlytics.operators import ingest as I

    base = os.path.join(tmp_dir, "landing")
    _write(base, "2025-07-14", "bad.json", [{"message_id": 9}])
    q = os.path.join(tmp_dir, "quarantine")
    for _ in range(2):  # a rerun of the same day
        I.load_exports(spark, base, dt.date(2025, 7, 14), os.path.join(tmp_dir, "raw"), q)
    assert spark.read.parquet(q).count() == 1


def test_landing_stream_equals_batch(spark, tmp_dir):
    """T1 over the JSON-lines landing layout gives the batch loader's table."""
    import datetime as dt

    from chanlytics import model
    from chanlytics.operators import ingest as I
    from chanlytics.sources.exports import write_landing
    from chanlytics.streaming import start_landing_ingest
    from pyspark.sql import types as T

    schema = T.StructType(list(model.EXPORT_SCHEMA.fields) + [T.StructField("scrape_date", T.DateType())])
    d1, d2 = dt.date(2025, 7, 14), dt.date(2025, 7, 15)
    rows = [(1, "Chemed", dt.date(2025, 7, 10), "a", 1, 0, False, None, d1),
            (2, "Chemed", dt.date(2025, 7, 10), "b", 1, 0, False, None, d1),
            (2, "Chemed", dt.date(2025, 7, 11), "b2", 9, 0, False, None, d2),
            (3, "TikvahPharma", dt.date(2025, 7, 11), None, None, None, True, None, d2)]
    base = os.path.join(tmp_dir, "lines")
    write_landing(spark.createDataFrame(rows, schema), base)
    raw_s = os.path.join(tmp_dir, "raw_s")
    start_landing_ingest(spark, base, raw_s, os.path.join(tmp_dir, "ck")).awaitTermination(120)
    raw_b = os.path.join(tmp_dir, "raw_b")
    for d in (d1, d2):
        I.load_landing_day(spark, base, d, raw_b)

    def rows_of(p):
        return sorted((r.message_id, r.channel_username, r.views, str(r.scrape_date))
                      for r in spark.read.parquet(p).collect())
    assert rows_of(raw_s) == rows_of(raw_b)
    assert len(rows_of(raw_s)) == 3


def _lines(base, name, values, channel="Chemed", day="2025-07-14"):
    folder = os.path.join(base, f"scrape_date={day}", f"channel={channel}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(v if isinstance(v, str) else json.dumps(v | {"source_pos": v["message_id"]}) + "\n" for v in values)


def test_an_export_is_judged_whole_however_its_files_arrive(spark, tmp_dir):
    """Three files, the second with a bad line: the stream stores nothing of the export, as the batch does."""
    from chanlytics.sources.exports import seal_exports
    from chanlytics.streaming import start_landing_ingest

    base, raw = os.path.join(tmp_dir, "lines"), os.path.join(tmp_dir, "raw_s")
    quarantine = os.path.join(tmp_dir, "quarantine")
    day = dt.date(2025, 7, 14)

    def seal(*channels):
        seal_exports(spark.createDataFrame([(day, c) for c in channels], "scrape_date date, channel string"), base)

    def stream():
        start_landing_ingest(spark, base, raw, os.path.join(tmp_dir, "ck"), quarantine).awaitTermination(120)

    seal()  # the folder of seals exists before the first export is complete
    for name, values in [("a.txt", [_m(1), _m(2)]), ("b.txt", [_m(3), "{broken\n", _m(4)]), ("c.txt", [_m(5)])]:
        _lines(base, name, values)
        _lines(base, name, [v | {"message_id": v["message_id"] + 100} for v in values if isinstance(v, dict)], "TikvahPharma")
        stream()
        assert I.read_table(spark, raw, __import__("chanlytics.model", fromlist=["x"]).RAW_MESSAGES_SCHEMA).count() == 0
    seal("Chemed")
    seal("TikvahPharma")
    stream()
    I.load_landing_day(spark, base, day, os.path.join(tmp_dir, "raw_b"))

    def rows_of(p):
        return sorted((r.message_id, r.channel_username) for r in spark.read.parquet(p).collect())
    assert rows_of(raw) == rows_of(os.path.join(tmp_dir, "raw_b"))
    assert [i for i, _ in rows_of(raw)] == [101, 102, 103, 104, 105]
    assert [r.source_file for r in spark.read.parquet(quarantine).collect()] == ["2025-07-14/Chemed"]
    stream()
    assert len(rows_of(raw)) == 5


def test_parts_of_an_export_are_judged_together(spark, tmp_dir):
    """The loader over array files in parts: a bad part rejects its export; the exporter's own layout beside it."""
    from chanlytics.sources.exports import write_exports

    base, raw = os.path.join(tmp_dir, "arrays"), os.path.join(tmp_dir, "raw")
    files = [("2025-07-14/Chemed.json", 0, json.dumps([_m(1), _m(2)])), ("2025-07-14/Chemed.json", 1, "[{broken"),
             ("2025-07-14/TikvahPharma.json", 0, json.dumps([_m(3, "TikvahPharma")])),
             ("2025-07-14/TikvahPharma.json", 1, json.dumps([_m(4, "TikvahPharma"), _m(3, "TikvahPharma", views=9)])),
             ("2025-07-15/Chemed.json", 0, json.dumps([_m(6)]))]
    write_exports(spark.createDataFrame(files, "source_file string, part int, content string"), base)
    _write(base, "2025-07-14", "Lobelia4Cosmetics.json", [_m(7, "Lobelia4Cosmetics")])
    acc, rejected = I.load_exports(spark, base, dt.date(2025, 7, 14), raw)
    assert [(r.source_file, r.reason) for r in rejected.collect()] == [("2025-07-14/Chemed.json", "unparsable")]
    got = sorted((r.message_id, r.views) for r in spark.read.parquet(raw).collect())
    assert got == [(3, 1), (4, 1), (7, 1)]
    assert {r.source_file.rsplit("/", 1)[-1]: (r.recorded, r.skipped) for r in acc.collect()} == {
        "TikvahPharma.json": (2, 1), "Lobelia4Cosmetics.json": (1, 0)}
    I.load_exports(spark, base, None, raw)  # all days
    rows = spark.read.parquet(raw).collect()
    assert {(r.message_id, r.scrape_date.day) for r in rows} == {(3, 14), (4, 14), (7, 14), (6, 15)}


def test_file_shipped_scorer_equals_in_memory(spark, tmp_dir):
    """E1 with the model shipped by addFile and loaded per worker gives the same detections."""
    from pyspark.sql import functions as F

    from chanlytics.operators.detect import (
        CentroidFileScorer, CentroidScorer, detect_objects, fit_centroids,
    )
    from chanlytics.sources import driver_tables as D

    sf = "/root/testdata/sf0.001"
    cents, labels = fit_centroids(D.table(spark, sf, "embeddings"))
    names = [f"class{k}" for k in labels]
    images = D.image_paths(spark, sf).select(F.col("image_path").alias("path"),
                                             F.col("embedding").alias("content"))
    mapping = {c: c for c in [f"src{i}" for i in range(20)]}
    name = CentroidFileScorer.ship(spark, cents, os.path.join(tmp_dir, "centroids-test.npy"))

    def rows(scorer):
        det = detect_objects(images, scorer, dt.datetime(2025, 7, 15), mapping).detections
        return sorted((r.detection_id, str(r.confidence_score)) for r in det.collect())
    assert rows(CentroidFileScorer(name, names)) == rows(CentroidScorer(cents, names))


def test_worker_models_go_by_content():
    """A worker keeps a model for scorers of the same content and class only, wherever these lie in memory."""
    import numpy as np
    import pandas as pd

    from chanlytics.operators import detect
    from chanlytics.operators.detect import CentroidBytesScorer, CentroidFileScorer, CentroidScorer

    c = np.eye(2)
    vector = np.array([1.0, 0.0], dtype="<f4")
    held = {}
    plain, of_bytes = CentroidScorer(c, ["a", "b"]), CentroidBytesScorer(c, ["a", "b"])
    # an address is given again after its object is freed, to another scorer
    assert plain.token == CentroidScorer(c.copy(), ["a", "b"]).token
    for other in (CentroidScorer(c[::-1], ["a", "b"]), CentroidScorer(c, ["b", "a"]), CentroidScorer(c, ["a", "b"], 0.5)):
        assert other.token != plain.token
    assert CentroidFileScorer("x.npy", ["a"], 0.2).token != CentroidFileScorer("x.npy", ["a"], 0.5).token
    before, detect._WORKER_MODELS = detect._WORKER_MODELS, held
    try:
        assert detect._worker_model(plain).predict(pd.Series([vector])) == [[(0, 1.0)]]
        assert detect._worker_model(of_bytes).predict(pd.Series([vector.tobytes()])) == [[(0, 1.0)]]
        assert len(held) == 2
    finally:
        detect._WORKER_MODELS = before


def test_image_stream_lists_in_few_tasks(spark, tmp_dir):
    """The number of tasks that list a micro-batch's files does not grow with the files."""
    from pyspark.sql.types import StructType

    img, files = os.path.join(tmp_dir, "img"), 40
    os.makedirs(img)
    for i in range(files):
        with open(os.path.join(img, f"Chemed_{i}.jpg"), "wb") as f:
            f.write(b"x" * (i + 1))
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, log = spark.conf.get(key), StructType.fromDDL("image_path string, n_boxes int, scored_at timestamp_ntz")
    q = start_image_scoring(spark, img, LengthScorer(), os.path.join(tmp_dir, "det"), os.path.join(tmp_dir, "ck"),
                            os.path.join(tmp_dir, "log"))
    q.awaitTermination()
    status = spark.sparkContext.statusTracker()
    stages = [s for j in status.getJobIdsForGroup(str(q.runId)) for s in status.getJobInfo(j).stageIds]
    tasks = [i.numTasks for i in map(status.getStageInfo, stages) if i is not None]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism < files
    assert spark.conf.get(key) == before
    # images of so few bytes hold no box, but each is logged
    assert {r.image_path for r in I.read_table(spark, os.path.join(tmp_dir, "log"), log).collect()} == {
        f"data/images/Chemed_{i}.jpg" for i in range(files)}


class KeepingScorer(Scorer):
    """Test detector: no boxes; each image leaves a file in a folder."""

    class_names = ["blob"]

    def __init__(self, folder):
        self.folder, self.token = folder, f"keeping-{folder}"

    def predict(self, payloads: pd.Series):
        import uuid

        for p in payloads:
            with open(os.path.join(self.folder, f"{len(p)}-{uuid.uuid4().hex}"), "wb"):
                pass
        return [[] for _ in payloads]


def _images(folder, sizes):
    os.makedirs(folder, exist_ok=True)
    for i in sizes:
        with open(os.path.join(folder, f".Chemed_{i}.jpg"), "wb") as f:
            f.write(b"x" * i)
        os.replace(f.name, os.path.join(folder, f"Chemed_{i}.jpg"))  # a running stream sees whole files


def test_image_stream_leaves_paths_out_of_the_driver(spark, tmp_dir):
    """The driver's own logs name no image, and without a scan log an image is still scored once."""
    img, seen, ck = (os.path.join(tmp_dir, n) for n in ("img", "seen", "ck"))
    os.makedirs(seen)
    for sizes in (range(1, 13), range(13, 16), ()):
        _images(img, sizes)
        start_image_scoring(spark, img, KeepingScorer(seen), os.path.join(tmp_dir, "det"), ck).awaitTermination()
    assert sorted(int(n.split("-")[0]) for n in os.listdir(seen)) == list(range(1, 16))
    for folder, _, names in os.walk(ck):
        for n in names:
            if ".parquet" not in n:
                with open(os.path.join(folder, n), "rb") as f:
                    assert b"Chemed_" not in f.read(), n


def test_image_stream_with_a_processing_time(spark, tmp_dir):
    """Images that arrive while the stream runs are scored, each once."""
    import time

    img, seen = os.path.join(tmp_dir, "img"), os.path.join(tmp_dir, "seen")
    os.makedirs(seen)
    _images(img, [1, 2])
    q = start_image_scoring(spark, img, KeepingScorer(seen), os.path.join(tmp_dir, "det"), os.path.join(tmp_dir, "ck"),
                            available_now=False, processing_time="1 second")
    try:
        for sizes, count in (([], 2), ([3, 4, 5], 5)):
            _images(img, sizes)
            until = time.time() + 120
            while len(os.listdir(seen)) < count and q.isActive and time.time() < until:
                time.sleep(0.5)
        q.processAllAvailable() if not q.isActive else time.sleep(3)  # a failed stream raises here
    finally:
        q.stop()
    assert sorted(int(n.split("-")[0]) for n in os.listdir(seen)) == [1, 2, 3, 4, 5]


def test_image_scan_is_small_and_its_listing_is_not_kept(spark, tmp_dir, monkeypatch):
    """A scan of the stream opens 10,000 files at most, in a few tasks a slot, and Spark caches no listing of it."""
    import inspect

    from chanlytics.operators import detect

    img, seen = os.path.join(tmp_dir, "img"), []
    _images(img, range(1, 41))
    scan = detect._content_scan

    def watched(session, paths):
        cache, tasks = "spark.sql.hive.filesourcePartitionFileCacheSize", session.conf.get("spark.sql.files.maxPartitionNum", None)
        files = scan(session, paths)
        seen.append((session.conf.get(cache), int(tasks), files.rdd.getNumPartitions()))
        return files
    monkeypatch.setattr(detect, "_content_scan", watched)
    start_image_scoring(spark, img, LengthScorer(), os.path.join(tmp_dir, "det"), os.path.join(tmp_dir, "ck")).awaitTermination()
    assert [(c, t) for c, t, _ in seen] == [("0", 4 * spark.sparkContext.defaultParallelism)]
    assert all(n <= t for _, t, n in seen)
    assert inspect.signature(detect.run_detection).parameters["batch_paths"].default <= 10_000


def test_new_files_of_a_folder(spark, tmp_dir):
    from pyspark.errors import AnalysisException

    from chanlytics.sources.folders import folder_files, new_files

    img, state = os.path.join(tmp_dir, "img"), os.path.join(tmp_dir, "state")

    def put(*names):
        for n in names:
            os.makedirs(os.path.dirname(os.path.join(img, n)), exist_ok=True)
            with open(os.path.join(img, n), "wb") as f:
                f.write(b"x")

    def new(number):
        return sorted(r.path.removeprefix(f"file:{img}/") for r in new_files(spark, img, state, number, 2).collect())
    put("a b.jpg", "c%20d.jpg", "é[1].jpg", "e.txt", "f", ".hidden.jpg", "_hidden.jpg", "sub/g.jpg")
    first = ["a b.jpg", "c%20d.jpg", "e.txt", "f", "é[1].jpg"]
    assert new(0) == new(0) == first
    put("h.jpg")
    assert new(0) == sorted([*first, "h.jpg"])  # a listing that is made again has what has come since
    assert new(1) == []
    put("i.jpg")
    assert new(2) == new(2) == ["i.jpg"]
    os.remove(os.path.join(img, "a b.jpg"))
    assert new(3) == []
    put("a b.jpg", "j.jpg")  # as of the file source, a path is new once
    assert new(4) == ["j.jpg"] and new(5) == []
    assert len(os.listdir(os.path.join(state, "seen"))) <= 3
    # the same paths as Spark's readers have, of a local folder, of another store, of a pattern, and of partition folders
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.folders.link./in", f"file://{tmp_dir}")
    put("../parts/day=1/k.jpg", "../parts/day=2/l.jpg")
    for name in (os.path.join(tmp_dir, "parts"), "viewfs://folders/in/parts", "viewfs://folders/in/img", img, os.path.join(img, "s*")):
        want = {r.path for r in spark.read.format("binaryFile").load(name).select("path").collect()}
        assert set(folder_files(spark, name)) == want and want, name
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        start_image_scoring(spark, os.path.join(tmp_dir, "none"), LengthScorer(), os.path.join(tmp_dir, "det"), os.path.join(tmp_dir, "ck"))
