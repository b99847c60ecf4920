import json
import struct
import zlib

import numpy as np
import pytest

from roadlens import sinks
from roadlens.config import Settings, read_descriptor
from roadlens.functions.fingerprint import fingerprints
from roadlens.operators import detect
from roadlens.sources import images, layouts, voc, yolo


def png(path, w, h, at=lambda x, y: ((x * x * 3 + y * 11) % 256, (x * y * 7 + x) % 256, 40)):
    raw = b"".join(b"\0" + bytes(v for x in range(w) for v in at(x, y)) for y in range(h))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    r = tmp_path_factory.mktemp("set")
    png(r / "images/train/s1_1.png", 40, 30)
    png(r / "images/train/s1_2.PNG", 40, 30, lambda x, y: ((x * x * 3 + y * 11) % 256, (x * y * 7 + x) % 256, 44))
    png(r / "images/val/s2_1.png", 20, 60, lambda x, y: (y * 9 % 256, 3, x))
    (r / "images/val/bad.png").write_bytes(b"nothing")
    (r / "images/val/note.md").write_text("x")
    (r / "labels/train").mkdir(parents=True)
    (r / "labels/train/s1_1.txt").write_text("\n3 0.5 0.5 0.2 0.2\nbad\n11 0 0 0 0\n")
    return r


def test_listing_and_decoding(spark, root):
    listed = {r["file_name"]: (r["split"], r["stem"]) for r in images.list_images(spark, f"{root}/images").collect()}
    assert listed == {"s1_1.png": ("train", "s1_1"), "s1_2.PNG": ("train", "s1_2"), "s2_1.png": ("val", "s2_1"), "bad.png": ("val", "bad")}
    decoded = {r["file_name"]: (r["readable"], r["width"]) for r in images.decode_images(spark, f"{root}/images").collect()}
    assert decoded["bad.png"] == (False, -1) and decoded["s2_1.png"] == (True, 20)
    assert images.hash_images(spark, f"{root}/images").select("md5").distinct().count() == 4


def test_fingerprints(spark, root):
    fps = {r["path"].rsplit("/", 1)[1]: r["fp"] for r in fingerprints(images.decode_images(spark, f"{root}/images").select("path", "height", "width", "nChannels", "data")).collect()}
    assert fps["bad.png"] is None
    near = (fps["s1_1.png"] ^ fps["s1_2.PNG"]) & (1 << 64) - 1
    far = (fps["s1_1.png"] ^ fps["s2_1.png"]) & (1 << 64) - 1
    assert near.bit_count() <= 6 < far.bit_count()


def test_detector_stub(spark, root):
    def load():
        return lambda batch: np.array([[[320.0], [320.0], [64.0], [64.0], [float(batch.max() <= 1)]]])

    out = detect.run_detector(images.decode_images(spark, f"{root}/images").select("path", "height", "width", "nChannels", "data"), load)
    boxes = detect.to_image_pixels(detect.decode_tensor(out.withColumnRenamed("path", "image_id")).join(out.withColumnRenamed("path", "image_id").drop("output"), "image_id"))
    got = {r["image_id"].rsplit("/", 1)[1]: tuple(round(r[k], 3) for k in ("x1", "y1", "x2", "y2")) for r in boxes.collect()}
    assert got == {"s1_1.png": (18.0, 13.0, 22.0, 17.0), "s1_2.PNG": (18.0, 13.0, 22.0, 17.0), "s2_1.png": (7.031, 27.0, 13.031, 33.0)}


def test_labels_and_manifest(spark, root, tmp_path):
    labels = yolo.read_labels(spark, f"{root}/labels")
    assert [(r["split"], r["stem"], r["line_no"], r["tokens"][:2]) for r in yolo.boxes(labels).orderBy("line_no").collect()] == [("train", "s1_1", 1, ["0", "0.5"]), ("train", "s1_1", 3, ["0", "0"])]
    assert yolo.first_class_ids(labels).first()["class_ids"] == [3, 11]
    (tmp_path / "m.csv").write_text("filename,sequence_id\ns1_1.png,x\ns1_1.png,y\n")
    items, missing = layouts.labelled_set(images.list_images(spark, f"{root}/images"), labels, "t", yolo.read_manifest(spark, str(tmp_path / "m.csv")))
    assert [(r["seq_id"], r["lines"]) for r in items.collect()] == [("t_y", ["0 0.5 0.5 0.2 0.2", "0 0 0 0 0"])]
    assert missing.first()["missing_labels"] == 3


XML = "<annotation><size><width>{w}</width><height>100</height></size><object><name>{n}</name><bndbox><xmin>10</xmin><ymin>20</ymin><xmax>30</xmax><ymax>60</ymax></bndbox></object></annotation>"


def test_voc(spark):
    rows = [("a", XML.format(w=200, n="D40")), ("b", XML.format(w=200, n=" D40")), ("c", XML.format(w=0, n="D40")), ("d", "<annotation><oops")]
    df = spark.createDataFrame(rows, "stem string, xml string")
    got = {r["stem"]: (r["xc"], r["yc"], r["w"], r["h"]) for r in voc.boxes(df, "stem").collect()}
    assert got["a"] == (0.1, 0.4, 0.1, 0.4) and got["c"][0] is None and "d" not in got and "b" not in got
    names = {r["stem"]: r["class_names"] for r in voc.class_names(df, "stem").collect()}
    assert names["b"] == ["D40"] and "d" not in names
    imgs = spark.createDataFrame([("a", "p/a", "a.jpg"), ("z", "p/z", "z.jpg")], "stem string, path string, file_name string")
    assert [r["lines"] for r in layouts.annotated_set(imgs, df.where("stem = 'a'"), "r").collect()] == [["0 0.100000 0.400000 0.100000 0.400000"]]


def test_mined_negatives(spark):
    one = spark.createDataFrame([("o.jpg",)], "file_name string")
    two = spark.createDataFrame([("w.jpg", "11 1 1 1 1"), ("v.jpg", "10 0 0 1 1 0 1")], "file_name string, body string")
    three = spark.createDataFrame([("x.jpg", XML.format(w=1, n="Pothole - Low")), ("y.jpg", XML.format(w=1, n="Patch and utility cut- Low"))], "file_name string, xml string")
    got = {r["file_name"]: r["category"] for r in layouts.mined_negatives(one, two, three).collect()}
    assert got == {"o.jpg": "generic", "w.jpg": "excluded", "v.jpg": "priority", "x.jpg": "excluded", "y.jpg": "priority"}


def test_sinks(spark, tmp_path):
    items = spark.createDataFrame([("train", "p1", ["0 1 1 1 1", "0 2 2 2 2"]), ("val", "p2", [])], "split string, path string, lines array<string>")
    sinks.write_dataset(items, str(tmp_path / "dry"), dry_run=True)
    assert not (tmp_path / "dry").exists()
    sinks.write_dataset(items, str(tmp_path / "v1"))
    assert {r["path"]: r["label_text"] for r in spark.read.parquet(str(tmp_path / "v1")).collect()} == {"p1": "0 1 1 1 1\n0 2 2 2 2\n", "p2": ""}
    sinks.write_survivors(items, spark.createDataFrame([("p1",)], "path string"), str(tmp_path / "v2"))
    assert spark.read.parquet(str(tmp_path / "v2")).count() == 1
    findings = spark.createDataFrame([("W", "V4")], "level string, rule string")
    assert sinks.raise_on_errors(findings) == 1
    with pytest.raises(ValueError, match="1 errors"):
        sinks.raise_on_errors(findings.union(spark.createDataFrame([("E", "V5")], "level string, rule string")))
    meta = json.loads(sinks.run_metadata(spark, items.groupBy("split").count().withColumnRenamed("count", "n")))
    assert meta["dataset_counts"] == {"train": 1, "val": 1} and meta["spark_version"] == spark.version


def test_settings_and_descriptor(tmp_path):
    assert Settings.from_environment({"ML_TIMEOUT_MS": "5", "ML_ALLOWED_ORIGINS": "a,b"}).origins == ["a", "b"]
    (tmp_path / "d.yaml").write_text("path: x\ntrain: images/train\nval: images/val\nnames:\n  0: pothole\n")
    assert read_descriptor(str(tmp_path / "d.yaml"))["names"] == {0: "pothole"}


def test_streaming_scores_like_batch(spark, sf, tmp_path):
    from roadlens.functions.severity import score_frames
    from roadlens.plans.fixtures import detections
    from roadlens.streaming.scoring import score_stream

    cols = ["image_id", "confidence", "x1", "y1", "x2", "y2", "width", "height"]
    rows = detections(spark, sf).select(*cols)
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    got = []
    score_stream(spark, str(tmp_path / "in"), lambda df, _: got.append({r["severity"]: r["count"] for r in df.groupBy("severity").count().collect()}), str(tmp_path / "cp")).awaitTermination()
    assert got == [{r["severity"]: r["count"] for r in score_frames(rows).groupBy("severity").count().collect()}]


def test_scoring_from_pixels_to_answers(spark, root):
    def load():
        # One box over the middle where the picture is light enough, and its double of less confidence.
        return lambda batch: np.array([[[320.0, 321.0], [320.0, 320.0], [64.0, 64.0], [64.0, 64.0], [0.9 if batch.mean() > 0.3 else 0.1, 0.5 if batch.mean() > 0.3 else 0.1]]])

    decoded = images.decode_images(spark, f"{root}/images")
    rows = {r["path"].rsplit("/", 1)[1]: json.loads(r["response"]) for r in detect.score_images(decoded, load, "v7").collect()}
    assert set(rows) == {"s1_1.png", "s1_2.PNG", "s2_1.png"}
    for r in rows.values():
        assert r["success"] and r["model_version"] == "v7" and r["inference_time_ms"] >= 0 and len(r["detections"]) <= 1
    some = [r["detections"][0] for r in rows.values() if r["detections"]]
    assert some and all(d["confidence"] == 0.9 and d["severity"]["label"] in ("minor", "moderate", "severe") for d in some)


def test_frames_without_detections_are_answered(spark):
    from roadlens.functions.severity import score_frames

    found = spark.createDataFrame([(1, 0.9, 1.0, 1.0, 5.0, 5.0, 10.0, 10.0)], "image_id long, confidence double, x1 double, y1 double, x2 double, y2 double, width double, height double")
    frames = spark.createDataFrame([(1, 2.345), (2, 1.0)], "image_id long, elapsed_ms double")
    rows = {r["image_id"]: json.loads(r["response"]) for r in detect.responses(score_frames(found), frames=frames).collect()}
    assert rows[2]["detections"] == [] and rows[2]["success"] and rows[1]["inference_time_ms"] in (2.34, 2.35) and len(rows[1]["detections"]) == 1
    ids = [r["request_id"] for r in detect.with_request_id(frames, "image_id").collect()]
    assert len(set(ids)) == 2 and all(len(i) == 8 for i in ids)


def test_augmented_pixels(spark, root):
    from roadlens.operators import augment

    rows = augment.augmented(images.decode_images(spark, f"{root}/images")).collect()
    assert len(rows) == 9 and {r["target_name"] for r in rows} >= {"aug0_s1_1.png", "aug2_s2_1.png"}
    assert all(len(r["data"]) == r["height"] * r["width"] * 3 for r in rows)


def test_layouts_that_are_there(spark, tmp_path):
    png(tmp_path / layouts.OS_V1 / "Images/o.png", 4, 4)
    png(tmp_path / layouts.WS_V1 / "Images/w.png", 4, 4)
    png(tmp_path / layouts.WS_V1 / "Images/none.png", 4, 4)
    (tmp_path / layouts.WS_V1 / "Labels").mkdir()
    (tmp_path / layouts.WS_V1 / "Labels/w.txt").write_text("10 0 0 1 1\n")
    assert {r["file_name"]: r["category"] for r in layouts.read_layouts(spark, str(tmp_path)).collect()} == {"o.png": "generic", "w.png": "priority"}
    with pytest.raises(ValueError, match="no layout"):
        layouts.read_layouts(spark, str(tmp_path / "nowhere"))


def test_one_label_of_a_stem_stays(spark):
    own = spark.createDataFrame([("b/s.txt", "s", "0 2 2 2 2"), ("a/s.txt", "s", "0 1 1 1 1")], "path string, stem string, body string")
    files = spark.createDataFrame([("i/s.jpg", "s.jpg", "s")], "path string, file_name string, stem string")
    items, told = layouts.labelled_set(files, own, "t")
    assert items.first()["lines"] == ["0 1 1 1 1"] and told.first()["duplicate_labels"] == 1 and told.first()["missing_labels"] == 0


def test_more_settings():
    s = Settings.from_environment({"ML_BACKEND": "onnx", "ML_HF_MODEL_REPO": "own/repo"})
    assert s.model_file == "best.onnx" and s.weights() == ("repository", "own/repo/best.onnx", "best")
    assert Settings().weights() == ("path", "models/best.pt", "best")


def test_report_and_contents(spark, root):
    row = spark.createDataFrame([(0.35, 0.5, 0.25, 0.4, 0.2, 45.0, 22.2, 50)], "confidence_threshold double, precision double, recall double, map50 double, map50_95 double, avg_ms double, fps double, latency_sample long")
    told = json.loads(sinks.evaluation_report(row, "w.pt", "val"))
    assert told["mAP50-95"] == 0.2 and told["split"] == "val" and told["note"] == sinks.NOTE
    listed = images.list_images(spark, f"{root}/images")
    assert sinks.with_contents(listed.select("path", "file_name"), f"{root}/images").where("length(content) > 0").count() == 4
    assert [r["file_name"] for r in images.in_name_order(listed).collect()] == ["s1_1.png", "s1_2.PNG", "bad.png", "s2_1.png"]


def test_scratch_tables_can_be_discarded(spark):
    from roadlens.session import discard, materialize

    one, two = materialize(spark.range(5)), materialize(spark.range(6))
    discard(one, spark.range(2))
    assert two.count() == 6
    with pytest.raises(Exception, match="(?i)not.exist|not found|no such"):
        one.count()
