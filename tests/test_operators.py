import random

import pytest
from pyspark.sql import functions as F

from roadlens.functions.severity import SeverityScorer, score_frames
from roadlens.operators import augment, components, dedupe, detect, evaluate, merge, negatives, sampling, similarity, split, stats, validate
from roadlens.session import materialize


def test_severity_of_two_boxes(spark):
    rows = [(1, 120.0, 300.0, 450.0, 470.0, 640.0, 480.0), (1, 500.0, 100.0, 540.0, 130.0, 640.0, 480.0)]
    df = spark.createDataFrame(rows, "image_id long, x1 double, y1 double, x2 double, y2 double, width double, height double")
    got = {r["x1"]: (r["severity"], round(r["severity_score"], 3)) for r in score_frames(df).collect()}
    assert got == {120.0: ("severe", 1.0), 500.0: ("minor", 0.155)}
    reasons = score_frames(df).select("x1", SeverityScorer().reasons(F.col("area_frac"), F.col("vpos"), F.col("n_in_frame")).alias("r")).collect()
    assert all(len(r["r"]) == 3 and "2 potholes" in r["r"][1] for r in reasons)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 220), rng.randrange(100, 220)) for _ in range(70)] + [(300, 300), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(max(find(a), find(b)))] = min(find(a), find(b))
    df = spark.createDataFrame([*edges, (None, 5), (5, None)], "src long, dst long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    smallest = {}
    for x in parent:
        smallest[find(x)] = min(smallest.get(find(x), x), x)
    assert got == {x: smallest[find(x)] for x in parent}


def test_components_of_stars_take_few_rounds(spark, monkeypatch):
    """Members linked to the smallest of their group, as pivots link them, and groups linked to one another: no round for each halving."""
    edges = [(100 * g, 100 * g + k) for g in range(8) for k in range(1, 100)] + [(100 * g + 7, 100 * g + 105) for g in range(0, 8, 2)]
    calls = []
    monkeypatch.setattr(components, "materialize", lambda df: calls.append(1) or materialize(df))
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {n: n // 200 * 200 for n in range(800)}
    assert len(calls) <= 2 + 2 * 3  # the edges, three rounds of two tables, the roots


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


@pytest.mark.parametrize("threshold", [0, 3, 6])
def test_near_pairs_against_brute_force(spark, threshold):
    rng = random.Random(threshold)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for f in list(fps):
        for _ in range(2):
            g = f
            for b in rng.sample(range(64), rng.randrange(0, 9)):
                g ^= 1 << b
            fps.append(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)] + [(999, None)], "id long, fp long")
    got = {(r["id_a"], r["id_b"], r["distance"]) for r in similarity.near_pairs(df, threshold).collect()}
    want = {(i, j, (fps[i] ^ fps[j]).bit_count()) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= threshold}
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_group_split_against_loop(spark, seed):
    import hashlib

    rng = random.Random(seed)
    groups = {f"g{i}": rng.choice([1, 2, 3, 40]) for i in range(rng.randrange(1, 60))}
    total = sum(groups.values())
    want, n = {}, {"train": 0, "val": 0}
    for g in sorted(groups, key=lambda g: (hashlib.md5(f"{seed}:{g}".encode()).hexdigest(), g)):
        to = "train" if n["train"] < total * 0.7 else "val" if n["val"] < total * 0.2 else "test"
        want[g] = to
        if to in n:
            n[to] += groups[g]
    df = spark.createDataFrame(list(groups.items()), "seq_id string, n int")
    assert {r["seq_id"]: r["split"] for r in split.assign_groups(df, seed=seed).collect()} == want


def test_validation_traps(spark):
    bodies = {"a": "\n\n0 0.5 0.5 0.2 0.2\n\n0 nan 0.5 0.1 0.1", "b": "  \n ", "c": "1_0 0 0 0 0\n0.0 0.5 0.5 0.1 0.1\n0 .5 5e-1 +0.1 inf", "d": "-3 0.5 0.5 0.2 0.2"}
    images = spark.createDataFrame([("train", k, f"{k}.jpg", k != "d") for k in "abcde"], "split string, stem string, file_name string, readable boolean")
    labels = spark.createDataFrame([("train", k, v) for k, v in bodies.items()] + [("val", "x", "")], "split string, stem string, body string")
    got = sorted((r["rule"], r["file"], r["line_no"]) for r in validate.validate(images, labels).collect())
    assert got == sorted(
        [("V5", "a.txt", 2), ("V8", "a.txt", 3), ("V4", "b.txt", None), ("V6", "c.txt", 1), ("V6", "c.txt", 2), ("V8", "c.txt", 3), ("V10", "c.txt", 3), ("V10", "c.txt", 3)][:7]
        + [("V2", "d.jpg", None), ("V3", "e.jpg", None), ("V11", "x.txt", None)]
    )
    found = spark.createDataFrame([("train", "images"), ("train", "labels"), ("val", "images")], "split string, part string")
    assert sorted(r["split"] for r in validate.missing_split_parts(["train", "val", "test"], found).collect()) == ["test", "val"]
    files = spark.createDataFrame([("train", "p1", "m"), ("val", "p2", "m"), ("train", "p3", "n")], "split string, path string, md5 string")
    assert validate.duplicate_images(files).count() == 0
    assert validate.duplicate_images(files, scope="dataset").count() == 1


def test_empty_dataset_ratio_and_cap(spark):
    images = spark.createDataFrame([], "split string, seq_id string")
    assert {r["split"]: r["ratio"] for r in stats.split_ratio(images).collect()} == {"train": 0.7, "val": 0.2, "test": 0.1}
    candidates = spark.createDataFrame([("a_1.jpg", "a_1")], "file_name string, stem string")
    assert split.inject_backgrounds(images, candidates).count() == 0


def test_injection_keeps_groups_whole(spark):
    images = spark.createDataFrame([("train" if i % 10 < 7 else "val", f"s{i}") for i in range(100)], "split string, seq_id string")
    candidates = spark.createDataFrame([(f"bg{i % 6}_{i}.jpg", f"bg{i % 6}_{i}") for i in range(60)], "file_name string, stem string")
    got = split.inject_backgrounds(images, candidates, 0.2).collect()
    assert len(got) == 20
    assert len({(r["group_id"], r["split"]) for r in got}) == len({r["group_id"] for r in got})
    assert len({r["group_id"] for r in split.inject_backgrounds(images, candidates, 0.2, independent=True).collect()}) == 20


def test_suppression_against_loop(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(8), i, float(x := rng.randrange(80)), float(y := rng.randrange(80)), float(x + rng.randrange(1, 50)), float(y + rng.randrange(1, 50)), rng.choice([0.35, 0.4, 0.7, 0.9])) for i in range(200)]
    df = spark.createDataFrame(rows, "image_id long, box_id long, x1 double, y1 double, x2 double, y2 double, confidence double")

    def iou(a, b):
        w, h = max(0, min(a[4], b[4]) - max(a[2], b[2])), max(0, min(a[5], b[5]) - max(a[3], b[3]))
        return w * h / ((a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - w * h)

    want = set()
    for image in range(8):
        kept = []
        for r in sorted((r for r in rows if r[0] == image and r[6] > 0.35), key=lambda r: (-r[6], *r[2:6], r[1])):
            if all(iou(r, k) <= 0.45 for k in kept):
                kept.append(r)
        want |= {k[1] for k in kept}
    assert {r["box_id"] for r in detect.suppress(df, 0.45, ties=["box_id"]).collect()} == want


def test_letterbox_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1280, 5), (640, 480)], "width int, height int")
    got = {r["width"]: r for r in detect.letterboxed(df).collect()}
    assert got[1280]["new_h"] == 2 and got[1280]["pad_top"] == 319 and got[640]["pad_top"] == 80


def test_tensor_decode(spark):
    df = spark.createDataFrame([(1, [[10.0, 50.0], [20.0, 60.0], [4.0, 8.0], [6.0, 2.0], [0.9, 0.1]])], "image_id long, output array<array<double>>")
    assert [tuple(r) for r in detect.decode_tensor(df).collect()] == [(1, 0, 0.9, 8.0, 17.0, 12.0, 23.0)]


def test_parity_of_unequal_counts(spark):
    cols = "image_id long, confidence double, x1 double, y1 double, x2 double, y2 double"
    a = spark.createDataFrame([(1, 0.9, 0.0, 0.0, 10.0, 10.0), (2, 0.9, 0.0, 0.0, 10.0, 10.0)], cols)
    b = spark.createDataFrame([(1, 0.91, 0.1, 0.0, 10.0, 10.0)], cols)
    got = {r["image_id"]: (r["ok"], r["n_a"], r["n_b"], round(r["rel_diff"], 4)) for r in evaluate.parity(a, b, []).collect()}
    assert got == {1: (True, 1, 1, 0.01), 2: (False, 1, 0, 0.0)}


def test_average_precision_by_hand(spark):
    m = spark.createDataFrame([(0.5, 0.9, 1), (0.5, 0.8, 0), (0.5, 0.7, 1)], "threshold double, confidence double, tp int")
    ap = evaluate.average_precision(m, 2).first()["ap"]
    assert abs(ap - (51 * 1.0 + 50 * 2 / 3) / 101) < 1e-12
    assert [tuple(r) for r in evaluate.precision_recall(m, 4).collect()] == [(0.5, 3, 2, 2 / 3, 0.5)]


def test_latency_of_nothing(spark):
    assert tuple(evaluate.latency(spark.createDataFrame([], "elapsed_ms double")).first()) == (0, None, None)


def test_negative_traps(spark):
    df = spark.createDataFrame([(1, [2]), (2, [11, 4]), (3, [4, 1]), (4, []), (5, [99, -1])], "id int, class_ids array<int>")
    got = {r["id"]: (r["category"], r["classes_present"]) for r in negatives.classify_ids(df).collect()}
    assert got == {1: ("generic", "Alligator crack - low"), 2: ("excluded", "Faded marking - High; Pothole - High"), 3: ("priority", "Alligator crack - Low; Faded marking - High"), 4: ("generic", "(empty)"), 5: ("generic", "(empty)")}


def test_gates_in_order(spark):
    rows = [(False, "image/gif", 99.0, False, 1.0), (True, "image/gif", 99.0, False, 1.0), (True, "image/png", 11.0, False, 1.0), (True, "image/png", 10.0, False, 1.0), (True, "image/jpeg", 1.0, True, 99999.0)]
    df = spark.createDataFrame(rows, "model_loaded boolean, content_type string, size_mb double, decodable boolean, elapsed_ms double")
    assert sorted((r["status_code"], r["slow"]) for r in detect.gates(df).collect()) == [(200, True), (400, False), (413, False), (415, False), (503, False)]


def test_merge_keeps_smallest_name_and_groups(spark):
    cols = "source string, path string, file_name string, stem string, lines array<string>, seq_id string"
    one = spark.createDataFrame([("a", f"a/{i}", f"s{i // 3}_{i}.jpg", f"s{i // 3}_{i}", ["0 1 1 1 1"], f"a_s{i // 3}") for i in range(12)], cols)
    two = spark.createDataFrame([("b", "b/0", "a_first.jpg", "a_first", [], "b_a")], cols)
    prints = spark.createDataFrame([(f"a/{i}", f"m{i}", i * 1000003) for i in range(12)] + [("b/0", "m5", None)], "path string, md5 string, fp long")
    got = merge.merge_sources([one, two], prints, exact_only=True).collect()
    assert "a/5" not in {r["path"] for r in got} and "b/0" in {r["path"] for r in got} and len(got) == 12
    assert len({(r["seq_id"], r["split"]) for r in got}) == len({r["seq_id"] for r in got})


def test_removals_are_distinct(spark):
    ranked = spark.createDataFrame([("train", "p1", 1), ("train", "p2", 2)], "split string, path string, rank int")
    bad = spark.createDataFrame([("train", "p2"), ("train", "p2")], "split string, path string")
    assert [tuple(r) for r in dedupe.removals(ranked, bad).collect()] == [("train", "p2", "corrupted")]


def test_samples(spark):
    df = spark.createDataFrame([(f"f{i}.png", ".png") for i in range(9)], "file_name string, ext string")
    a, b = (sorted(r[0] for r in sampling.seeded_sample(d, 4, "file_name").collect()) for d in (df, df.repartition(7)))
    assert a == b and len(a) == 4 and sampling.seeded_sample(df, 99, "file_name").count() == 9
    assert sampling.first_of_kinds(df, n=3).count() == 3 and sampling.seeded_fraction(df, 0.5, "file_name").count() == 4


def test_augmentation(spark):
    import numpy as np

    rows = augment.plan(spark.createDataFrame([("a.jpg",), ("b.jpg",)], "file_name string")).collect()
    assert len(rows) == 6 and all(25 <= r["brightness"] <= 55 and 3 <= r["warmth"] <= 10 for r in rows)
    grey = np.full((2, 2, 3), 100, np.uint8)
    assert augment.lighten_and_warm(grey, 30, 5).tolist()[0][0] == [128, 130, 135]
    assert augment.lighten_and_warm(np.full((1, 1, 3), 250, np.uint8), 30, 5).max() == 255


@pytest.mark.parametrize("together", [1, 2, 3, 4])
def test_near_prints_by_any_number_of_bands(spark, together):
    rng = random.Random(together)
    fps = {0, -1, 1 << 62}
    for f in [rng.getrandbits(63) for _ in range(12)]:
        for n in (0, 1, 5, 6, 7):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(63), n)))
    fps = sorted(fps)
    bits = lambda x: bin(x & (1 << 64) - 1).count("1")
    got = sorted(tuple(r) for r in similarity.near_prints(spark.createDataFrame([(f,) for f in fps], "fp long"), 6, together).collect())
    assert got == sorted((a, b, bits(a ^ b)) for a in fps for b in fps if a < b and bits(a ^ b) <= 6)


def test_equal_prints_are_linked_in_a_star(spark):
    df = spark.createDataFrame([(i, 5 if i < 400 else 7 + (i << 20)) for i in range(410)] + [(999, None)], "id long, fp long")
    edges = similarity.near_edges(df, 6).collect()
    assert len(edges) < 500
    cluster = {r["id"]: r["cluster"] for r in dedupe.clusters(df).collect()}
    assert all(cluster[i] == 0 for i in range(400)) and cluster[999] == 999


def test_exact_only_clusters_need_no_graph(spark):
    df = spark.createDataFrame([("p1", "m"), ("p0", "m"), ("p2", None), ("p3", None), ("p4", "n")], "path string, md5 string")
    assert {r["path"]: r["cluster"] for r in dedupe.clusters(df, "path", exact_only=True).collect()} == {"p0": "p0", "p1": "p0", "p2": "p2", "p3": "p3", "p4": "p4"}


def test_large_samples_take_whole_cells(spark, monkeypatch):
    df = spark.range(3000).selectExpr("concat('f', id) AS file_name")
    want = [r[0] for r in df.orderBy(sampling.seeded_key(42, df["file_name"]), "file_name").collect()]
    monkeypatch.setattr(sampling, "SORTED_ROWS", 10)
    monkeypatch.setattr(sampling, "CELL_DIGITS", 1)
    for n in (11, 1500, 2999, 3000, 4000):
        assert sorted(r[0] for r in sampling.seeded_sample(df, n, "file_name").collect()) == sorted(want[:n])


def test_group_split_against_a_loop(spark):
    import hashlib

    sizes = {f"g{i}": 1 + i * i % 13 for i in range(200)}
    total, done, taken, want = sum(sizes.values()), 0, 0, {}
    for g in sorted(sizes, key=lambda g: (hashlib.md5(f"42:{g}".encode()).hexdigest(), g)):
        if done < 0.7 * total:
            want[g], taken = "train", taken + sizes[g]
        else:
            want[g] = "val" if done - taken < 0.2 * total else "test"
        done += sizes[g]
    got = split.assign_groups(spark.createDataFrame(list(sizes.items()), "seq_id string, n long")).collect()
    assert {r["seq_id"]: r["split"] for r in got} == want


def test_validation_tells_of_parts_duplicates_and_leaks(spark, monkeypatch):
    images = spark.createDataFrame([("train", "a", "a.jpg"), ("train", "a", "a.png"), ("train", "b", "b.jpg"), ("val", "c", "c.jpg")], "split string, stem string, file_name string")
    labels = spark.createDataFrame([("train", "a", "0 0.5 0.5 0.2 0.2\n1 0.5"), ("train", "z", ""), ("test", "t", "x")], "split string, stem string, body string")
    files = spark.createDataFrame([("train", "p1", "m", 1), ("train", "p2", "m", 1), ("train", "p3", "m", 9), ("val", "p4", "n", 3)], "split string, path string, md5 string, fp long")
    got = sorted((r["rule"], r["split"] or "", r["file"] or "", r["line_no"] or 0) for r in validate.validate(images, labels, files=files, splits=validate.SPLITS).collect())
    assert got == sorted([("V1", "test", "", 0), ("V1", "val", "", 0), ("V11", "train", "z.txt", 0), ("V12", "train", "", 0), ("V13", "", "", 0), ("V13", "", "", 0), ("V13", "", "", 0), ("V3", "train", "b.jpg", 0), ("V5", "train", "a.txt", 2)])
    told = {r["message"] for r in validate.leaked_images(files).collect()}
    assert "possible cross-split leakage: p1 (train) ~= p4 (val) (phash distance 1)" in told
    assert not validate.verdict(validate.validate(images.limit(0), labels.limit(0), files=files)).first()["passed"]
    monkeypatch.setattr(validate, "NAMED_PATHS", 1)
    assert sum(r["message"].count("p") - r["message"].split("(")[0].count("p") for r in validate.duplicate_images(files).collect()) == 3


def test_report_of_a_perfect_detector(spark):
    truth = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 50.0, 50.0, 60.0, 60.0)], "image_id long, gt_id int, x1 double, y1 double, x2 double, y2 double")
    found = truth.selectExpr("image_id", "0.9D AS confidence", "x1", "y1", "x2", "y2")
    runs = spark.createDataFrame([(10.0,), (30.0,)], "elapsed_ms double")
    row = evaluate.report(evaluate.match(truth, found, evaluate.IOU_GRID), 2, runs).first()
    assert (row["precision"], row["recall"], round(row["map50"], 9), round(row["map50_95"], 9), row["avg_ms"], row["fps"], row["latency_sample"]) == (1, 1, 1, 1, 20, 50, 2)


@pytest.mark.parametrize("together", [1, 2, 3, 4])
def test_keys_of_fingerprints_are_never_broadcast(spark, together):
    """Not even of a small table: its size says nothing of the keys that each fingerprint has. Both sides read one shuffle."""
    prints = materialize(spark.range(400).selectExpr("xxhash64(id) AS fp"))
    near = similarity.near_prints(prints, 6, together)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    near.collect()
    done = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in done and "Broadcast" not in done and "ReusedExchange" in done
    keys = similarity.band_keys(prints, 6, together)
    assert keys.where(similarity._below(F.col("bands")) != F.col("below")).isEmpty()


def greedy(truth, found, t):
    """(confidence, tp) of a frame's predictions (confidence, box) against boxes, by a plain loop."""
    used, out = set(), []
    for confidence, a in sorted(found, key=lambda f: (-f[0], f[1])):
        best = (-1.0, 0)
        for k, b in enumerate(truth):
            w, h = max(0.0, min(a[2], b[2]) - max(a[0], b[0])), max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
            union = sum((x[2] - x[0]) * (x[3] - x[1]) for x in (a, b)) - w * h
            best = max(best, (-1.0 if k in used else w * h / union if union > 0 else 0.0, -k))
        if truth and best[0] >= t:
            used.add(-best[1])
        out.append((confidence, int(bool(truth) and best[0] >= t)))
    return out


def test_steps_of_contended_and_plain_frames(spark):
    """Frames where boxes compete and frames where none do, against a plain loop, by rows and summed side by side."""
    rng = random.Random(11)
    box = lambda s: (lambda x, y: (x, y, x + rng.choice([8.0, 10.0]), y + 10.0))(rng.randrange(s) / 2, rng.randrange(s) / 2)
    frames = {i: ([box(6 if i % 2 else 200) for _ in range(rng.randrange(4))], [(rng.randrange(1, 6) / 8, box(6 if i % 2 else 200)) for _ in range(rng.randrange(1, 5))]) for i in range(60)}
    for i in range(0, 60, 2):
        frames[i][1].extend((0.9, b) for b in frames[i][0])
    truth = spark.createDataFrame([(i, k, *b) for i, (g, _) in frames.items() for k, b in enumerate(g)], "image_id long, gt_id int, x1 double, y1 double, x2 double, y2 double")
    found = spark.createDataFrame([(i, c, *b) for i, (_, p) in frames.items() for c, b in p], "image_id long, confidence double, x1 double, y1 double, x2 double, y2 double")
    for grid in (evaluate.IOU_GRID, [0.0, 0.3]):
        want = {}
        for t in grid:
            for g, p in frames.values():
                for c, tp in greedy(g, p, t):
                    n, m = want.get((t, c), (0, 0))
                    want[t, c] = (n + 1, m + tp)
        own = evaluate.match_steps(truth, found, grid)
        assert {(r["threshold"], r["confidence"]): (r["n"], r["t"]) for r in own.collect()} == want
        rows = evaluate.steps(evaluate.match(truth, found, grid))
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, own.collect()))
        assert sum(t for _, t in want.values()) > 100
