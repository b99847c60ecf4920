"""Stateful streams against batch scoring, pictures decoded again, ranks and curves in ranges."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.functions.severity import score_frames
from roadlens.operators import dedupe, detect, evaluate, ranks, render, validate
from roadlens.sources import file_tree, images
from roadlens.streaming import frames
from tests.test_sources import png

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def detection(rng, image, second):
    return (image, START + timedelta(seconds=second), rng.random(), *[float(rng.randrange(0, 100)) for _ in range(2)], *[float(rng.randrange(100, 400)) for _ in range(2)], 640.0, 480.0)


@pytest.mark.parametrize("seed", [1, 2])
def test_frames_over_several_files_are_scored_once(spark, tmp_path, seed):
    rng = random.Random(seed)
    every = [detection(rng, i, i * 5 + rng.randrange(20)) for i in range(30) for _ in range(rng.randrange(1, 4))]
    files = [[] for _ in range(4)]
    for d in every:
        files[min(3, max(0, int((d[1] - START).total_seconds() // 45) + rng.randrange(2)))].append(d)
    files[1].append(files[0][0])  # an upload that comes again
    late = (0, START + timedelta(seconds=4000), 0.5, 1.0, 1.0, 2.0, 2.0, 640.0, 480.0)
    rounds = [*files, [(900, START + timedelta(seconds=3000), 0.5, 1.0, 1.0, 2.0, 2.0, 640.0, 480.0)], [late], [(901, START + timedelta(seconds=9000), 0.5, 1.0, 1.0, 2.0, 2.0, 640.0, 480.0)]]
    got, told = [], []

    def sink(scored, tardy, number):
        got.extend(tuple(r) for r in scored.select("image_id", "confidence", "n_in_frame", F.round("severity_score", 9), "severity").collect())
        told.extend(r["image_id"] for r in tardy.collect())

    for k, rows in enumerate(rounds):
        spark.createDataFrame(rows, frames.DETECTION_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        frames.score_frame_stream(spark, str(tmp_path / "in"), sink, str(tmp_path / "ck"), wait=60, lateness=60, keep=10_000).awaitTermination()
        assert k > 3 or all(n[0] < 30 for n in got)
    batch = score_frames(spark.createDataFrame(sorted(set(every)), frames.DETECTION_SCHEMA))
    want = [tuple(r) for r in batch.select("image_id", "confidence", "n_in_frame", F.round("severity_score", 9), "severity").collect()]
    assert sorted(g for g in got if g[0] < 30) == sorted(want) and told == [0]
    assert [g[0] for g in got if g[0] >= 30] == [900]


def test_repeated_uploads_are_answered_from_state(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def answer(content):
        with open(calls / content.decode(), "a") as f:
            f.write("x")
        return f"said {content.decode()}"

    got = []
    for k, rows in enumerate([[("r1", b"a"), ("r2", b"b"), ("r3", b"a")], [("r4", b"a"), ("r5", b"c"), ("r6", None)]]):
        spark.createDataFrame([(r, START + timedelta(seconds=k), c) for r, c in rows], "request_id string, seen timestamp, content binary").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = spark.readStream.schema("request_id string, seen timestamp, content binary").parquet(str(tmp_path / "in"))
        own = lambda c: answer(c or b"none")
        query = frames.answer_uploads(arriving, own).writeStream.foreachBatch(lambda df, n: got.extend(tuple(r) for r in df.drop("md5").collect()))
        query.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    first = {r: (said, again) for r, said, again in got}
    assert {r: s for r, (s, _) in first.items()} == {"r1": "said a", "r2": "said b", "r3": "said a", "r4": "said a", "r5": "said c", "r6": "said none"}
    assert first["r4"][1] and not first["r2"][1] and not first["r5"][1] and first["r1"][1] != first["r3"][1]
    assert {p.name: len(p.read_text()) for p in calls.iterdir()} == {"a": 1, "b": 1, "c": 1, "none": 1}


# Pictures


def decoded(spark, tmp_path, files):
    file_tree.write_tree(files, str(tmp_path / "pictures"))
    out = {}
    for r in images.decode_images(spark, str(tmp_path / "pictures")).where("readable").collect():
        out[r["path"].rsplit("/", 1)[1]] = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["nChannels"])
    return out


def test_overlays_are_the_same_pixels_when_decoded(spark, tmp_path):
    png(tmp_path / "in/a.png", 60, 40)
    png(tmp_path / "in/b.png", 20, 30)
    (tmp_path / "in/bad.png").write_bytes(b"no")
    own = images.decode_images(spark, str(tmp_path / "in"))
    path = {r["file_name"]: r["path"] for r in own.collect()}
    boxes = spark.createDataFrame([(path["a.png"], 5.0, 18.0, 30.9, 35.0, "0.87 x?"), (path["a.png"], -10.0, -10.0, 100.0, 100.0, None), ("nowhere", 0.0, 0.0, 1.0, 1.0, None)], "path string, x1 double, y1 double, x2 double, y2 double, caption string")
    drawn = render.overlays(own, boxes).select(F.regexp_extract("path", "([^/]*)$", 1).alias("target"), "content")
    got = decoded(spark, tmp_path, drawn)
    plain = {r["file_name"]: np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], 3) for r in own.where("readable").collect()}
    assert set(got) == {"a.png", "b.png"} and (got["b.png"] == plain["b.png"]).all()
    a = plain["a.png"].copy()
    for x in range(5, 31):
        for y in range(18, 36):
            if x in (5, 6, 29, 30) or y in (18, 19, 34, 35):
                a[y, x] = (0, 255, 0)
    letters = np.zeros(a.shape[:2], bool)
    for i, c in enumerate("0.87 X?"):
        for row, bits in enumerate(render.GLYPHS.get(c, "77777")):
            for col in range(3):
                if int(bits) & 4 >> col:
                    letters[6 + 2 * row : 8 + 2 * row, 5 + 2 * (4 * i + col) : 7 + 2 * (4 * i + col)] = True
    a[letters] = (0, 0, 255)
    assert (got["a.png"] == a).all()


def test_encoder_keeps_all_pixels(spark, tmp_path):
    rng = np.random.default_rng(1)
    made = {"noise.png": rng.integers(0, 256, (17, 23, 3), dtype=np.uint8), "flat.png": np.full((5, 300, 3), 77, np.uint8), "dot.png": np.array([[[1, 2, 3]]], np.uint8), "ramp.png": np.arange(90, dtype=np.uint8).reshape(10, 3, 3)}
    files = spark.createDataFrame([(n, render.encode_png(p)) for n, p in made.items()], "target string, content binary")
    got = decoded(spark, tmp_path, files)
    assert all((got[n] == p).all() for n, p in made.items()) and len(render.encode_png(made["flat.png"])) < 200
    assert set(map(len, render.GLYPHS.values())) == {5}


def test_montages_stand_in_order(spark, tmp_path):
    for k in range(4):
        png(tmp_path / f"in/{k}.png", 20 + 10 * k, 20, lambda x, y, k=k: (40 * k, 10, 200))
    (tmp_path / "in/bad.png").write_bytes(b"no")
    own = images.decode_images(spark, str(tmp_path / "in"))
    path = {r["file_name"]: r["path"] for r in own.collect()}
    rows = [(1, path["2.png"], 2), (1, path["0.png"], 1), (1, path["bad.png"], 3), (1, path["1.png"], 4), (2, path["3.png"], 1), (2, path["3.png"], 9)]
    made = render.montages(own, spark.createDataFrame(rows, "cluster int, path string, position int"), tile=30)
    got = decoded(spark, tmp_path, made.select(F.concat("cluster", F.lit(".png")).alias("target"), "content"))
    assert got["1.png"].shape == (30, 120, 3) and got["2.png"].shape == (30, 30, 3)
    assert [tuple(got["1.png"][2, 30 * k + 2]) for k in (0, 1, 3)] == [(200, 10, 0), (200, 10, 80), (200, 10, 40)] and tuple(got["1.png"][0, 60]) == (0, 0, 255)


# Ranks and curves in ranges, classes of leaks


def test_ranks_and_sums_of_large_groups(spark):
    rng = random.Random(2)
    rows = [(None if i % 3 == 0 else i % 2, rng.randrange(500), i, rng.randrange(9)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g int, o int, i int, v int").repartition(7)
    got = ranks.running(df, ["g"], [-F.col("o"), F.col("i")], {"upto": F.col("v"), "n": F.lit(1)}).collect()
    assert len(got) == 4000
    for g in (None, 0, 1):
        own, total = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 0
        mine = {r["i"]: (r["upto"], r["n"]) for r in got if r["g"] == g}
        for k, r in enumerate(own, 1):
            total += r[3]
            assert mine[r[2]] == (total, k)


def test_average_precision_of_many_confidences(spark):
    rng = random.Random(4)
    rows = [(t, rng.random() if i % 10 else 0.25, int(rng.random() < 0.6)) for t in (0.5, 0.75) for i in range(6000)]
    got = {r["threshold"]: r["ap"] for r in evaluate.average_precision(spark.createDataFrame(rows, "threshold double, confidence double, tp int"), 5000).collect()}
    for t in (0.5, 0.75):
        steps = {}
        for _, c, tp in (r for r in rows if r[0] == t):
            n, k = steps.get(c, (0, 0))
            steps[c] = (n + 1, k + tp)
        n = k = 0
        best = [0.0] * 101
        for c in sorted(steps, reverse=True):
            n, k = n + steps[c][0], k + steps[c][1]
            for i in range(min(100, k * 100 // 5000) + 1):
                best[i] = max(best[i], k / n)
        assert abs(got[t] - sum(best) / 101) < 1e-9


def test_no_task_holds_all_confidences_of_a_threshold(spark):
    df = spark.range(20_000).selectExpr("0.5D AS threshold", "cast(id AS double) / 20000 AS confidence", "cast(id % 2 AS int) AS tp")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one range else
    try:
        cells = ranks.in_ranges(df, ["threshold"], [-F.col("confidence")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert cells.groupBy("__cell").count().agg(F.max("count")).first()[0] < 20_000
    ordered = cells.groupBy("__cell").agg(F.max("confidence").alias("hi"), F.min("confidence").alias("lo")).orderBy("__cell").collect()
    assert all(a["lo"] > b["hi"] for a, b in zip(ordered, ordered[1:]))
    members = spark.range(3000).selectExpr("1 AS cluster", "'train' AS split", "cast(id % 10 AS string) AS name", "cast(id AS string) AS path")
    assert sorted(r["rank"] for r in dedupe.keepers(members).collect()) == list(range(1, 3001))


def test_classes_of_leaks_count_all_pairs(spark):
    rng = random.Random(6)
    rows = [(f"p{i}", rng.choice([0, 1, 3, 255, 1 << 40, (1 << 40) + 7, None]), rng.choice(["train", "val", "test"])) for i in range(120)]
    files = spark.createDataFrame(rows, "path string, fp long, split string")
    classes = validate.leaked_classes(files)
    pairs = validate.leaked_images(files).count()
    assert classes.agg(F.sum(F.col("n_a") * F.col("n_b"))).first()[0] == pairs > classes.count()
    assert [(r["rule"], r["n"]) for r in validate.leak_counts(classes).collect()] == [("V13", pairs)]
    assert validate.leak_counts(validate.leaked_classes(files.limit(0))).count() == 0
    # A million copies of one frame are a row for each two splits.
    blank = spark.range(1_000_000).selectExpr("cast(id AS string) AS path", "0L AS fp", "element_at(array('train', 'val'), cast(id % 2 AS int) + 1) AS split")
    assert [(r["n_a"], r["n_b"]) for r in validate.leaked_classes(blank).collect()] == [(500_000, 500_000)]


def test_answers_do_not_depend_on_the_batch(spark, tmp_path):
    for k in range(7):
        png(tmp_path / f"in/{k}.png", 40 + k, 30)
    own = images.decode_images(spark, str(tmp_path / "in")).coalesce(1)

    def load():
        def model(x):
            n = len(x)
            out = np.zeros((n, 5, 6))
            for i in range(n):
                out[i, :4] = np.array([[100 + 40 * a, 120, 30, 30] for a in range(6)]).T
                out[i, 4] = [0.9, 0.2, 0.5, 0.34, 0.35, float(x[i].mean()) / 2 + 0.3]
            return out

        return model

    rows = {b: {r["path"]: r["response"].split("inference_time_ms")[0] for r in detect.score_images(own, load, "v", size=320, batch=b).collect()} for b in (1, 3, 64)}
    assert len(rows[1]) == 7 and rows[1] == rows[3] == rows[64]
    kept = detect.run_detector(own, load, 320, conf=0.35).select(F.size(F.col("output")[0]).alias("n")).collect()
    assert all(3 <= r["n"] <= 4 for r in kept) and detect.run_detector(own, load, 320).select(F.size(F.col("output")[0]).alias("n")).first()["n"] == 6


def test_weights_are_sent_as_a_file(spark, tmp_path):
    """A model of one weight, read in the worker, and read once there."""
    for k in range(5):
        png(tmp_path / f"in/{k}.png", 30 + k, 30)
    np.save(tmp_path / "weights.npy", np.array([0.75]))
    marks = tmp_path / "marks"
    marks.mkdir()

    def read(path):
        weight = float(np.load(path)[0])
        (marks / str(id(path))).write_text("read")

        def model(x):
            out = np.zeros((len(x), 5, 2))
            out[:, :4] = 50
            out[:, 4] = weight
            return out

        return model

    own = images.decode_images(spark, str(tmp_path / "in")).coalesce(1)
    load = detect.from_file(spark, str(tmp_path / "weights.npy"), read)
    rows = detect.run_detector(own, load, 320, batch=2).collect()
    assert len(rows) == 5 and all(r["output"][4] == [0.75, 0.75] for r in rows) and len(list(marks.iterdir())) == 1
