"""Filter audit, hard negatives and line dedup against plain loops."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import filter_audit, hard_negatives, line_dedup
from tests.llm.conftest import prose, rows_of

# Filter audit


def plain_audit(docs, labels):
    rows = []
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t))]
        fails.append(i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs))
        own = [x for x in labels if x[0] == i and i is not None]
        rows.append((source or "", fails, any(q == 1 for _, q, _ in own), any(x == 1 for _, _, x in own)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for p in permutations("ABCDE"):
            firsts = [next((k for k, c in enumerate(p, 1) if r[1]["ABCDE".index(c)]), 6) for r in mine]
            for k, c in enumerate(p, 1):
                at = "ABCDE".index(c)
                here = [r for r, f in zip(mine, firsts) if f == k]
                total[c] += len(here)
                out[part, "".join(p), k] = [
                    sum(f > k for f in firsts), len(here), sum(r[1][at] and f < k for r, f in zip(mine, firsts)), sum(r[1][at] and sum(r[1]) == 1 for r in mine), sum(r[2] for r in here), sum(r[3] for r in here),
                ]
        for p in permutations("ABCDE"):
            for k, c in enumerate(p, 1):
                out[part, "".join(p), k].append(total[c])
    return out


COUNTS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def audited(docs, labels):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COUNTS] for r in filter_audit.audit(docs, labels).collect()}


def test_audit_of_messy_documents(spark, messy, empty):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in rows_of(messy)] + [(500, "ABC $ def", "b"), (501, "ABC $ def", ""), (None, "ABC $ def", "b")]
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, source string, flags int, good boolean")
    labels = [(4, 1, 0), (4, None, None), (7, 1, 1), (8, 0, 1), (None, 1, 1), (501, None, 1), (9999, 1, 1), (100, 1, 0), (100, 1, 0)]
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audited(docs, told)
    assert got == plain_audit(rows, labels) and len(got) == 600 * len({r[2] or "" for r in rows})
    assert sum(v[1] for (_, p, _), v in got.items() if p == "ABCDE") + sum(v[0] for (_, p, k), v in got.items() if p == "ABCDE" and k == 5) == len(rows)
    assert filter_audit.audit(empty, told).count() == 0
    assert all(v[4] == v[5] == 0 for v in audited(docs, told.limit(0)).values())


def test_words_of_long_texts_in_stretches(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab \t\n\x0b") for _ in range(rng.randrange(0, 80))) for _ in range(300)] + ["", " ", "x" * 500, "é   é é"]
    monkeypatch.setattr(filter_audit, "STRETCH", 7)
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert filter_audit.word_counts(t.encode()) == (len(words), len(set(words))), t


def test_replay_of_other_filters(spark):
    flags = spark.createDataFrame([("p", 3, True, False), ("p", 2, False, True), ("p", 0, False, False)], "part string, flags int, good boolean, toxic boolean")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["good_lost"], r["shapley"]) for r in filter_audit.replay(flags, "XY").collect()}
    assert got == {("XY", 1): (2, 1, 0, 1, 1), ("XY", 2): (1, 1, 1, 0, 3), ("YX", 1): (1, 2, 0, 1, 3), ("YX", 2): (1, 0, 1, 0, 1)}
    for bad in ("", "XX", "ABCDEFG"):
        with pytest.raises(ValueError):
            filter_audit.filter_orders(spark, bad)


def test_a_task_sends_sums_not_documents(spark):
    flags = spark.range(50_000, numPartitions=4).selectExpr("concat('p', id % 2) AS part", "cast(id % 32 AS int) AS flags", "id % 3 = 0 AS good", "id % 5 = 0 AS toxic")
    plan = filter_audit.replay(flags)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "BroadcastNestedLoopJoin" in plan
    assert sum(r["removed"] for r in filter_audit.replay(flags).where("filter_order = 'ABCDE'").collect()) == 50_000 - len(range(0, 50_000, 32))


# Hard negatives


def plain_negatives(rows, every=50):
    kept = []
    for r, (i, v, label) in enumerate(rows):
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((r, i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for r, i, label, v in kept:
        if i % every:
            continue
        score = [(sum(a * b for a, b in zip(v, w)), j, other) for q, j, other, w in kept if len(w) == len(v) and (j != i or other != label)]
        best = sorted([(-s, j) for s, j, other in score if other == label and j != i])[:5]
        for s, j in best:
            found = sorted((-t, k) for t, k, other in score if other != label and 50 * -s <= 100 * t <= 95 * -s)[:3]
            out += [(i, j, n, k, -s, -t) for n, (t, k) in enumerate(found, 1)]
    return sorted(out)


def mined(df, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(hard_negatives.quantised(df, label), F.col("vec_id") % 50 == 0, **more)
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got.collect())


def test_negatives_against_a_plain_loop(spark):
    rng = random.Random(9)
    rows = [(i, [round(rng.gauss(1, 0.6), 1) for _ in range(4)], rng.randrange(4)) for i in range(400)]  # coarse: many ties
    rows += [(50, [1.0, 1.0, 1.0, 1.0], 2), (50, [1.0, 1.0, 1.0, 1.0], 2), (50, [0.5, 1.0, 1.0, 1.0], 3), (401, [1.0, 2.0], 1), (450, [1.0, 2.0], 1), (402, [2.0, 1.0], 2), (403, [1.0, 1.0], 2), (500, [-1.0, 0.0], 9), (501, [1.0, 0.0], 9), (-50, [0.0] * 4, 1)]
    rows += [(600, None, 1), (650, [], 1), (700, [1.0, None, 1.0, 1.0], 1), (750, [1.0, math.nan, 1.0, 1.0], 1), (800, [math.inf, 0.0, 0.0, 0.0], 1), (850, [1.0] * 4, None), (None, [1.0] * 4, 1)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<double>, label int, score int, row string")
    want = plain_negatives(rows)
    assert mined(df) == want and len(want) > 80
    assert mined(df, anchor_bytes=2000) == want  # many groups of anchors
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 50").limit(1)) == []


def test_small_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    best = hard_negatives.Best(6, 3)
    seen = [[] for _ in range(6)]
    for _ in range(30):
        at = np.sort(rng.choice(6, 4, replace=False))
        ids = np.sort(rng.integers(0, 1000, 5))
        found = rng.integers(0, 8, (4, 5))
        found[rng.random((4, 5)) < 0.3] = np.iinfo(np.int64).min
        for a, row in zip(at, found):
            seen[a] += [(-s, i) for s, i in zip(row.tolist(), ids.tolist()) if s >= 0]
        best.offer(at, found.copy(), ids)
    at, score, who = best.rows()
    assert [[(-s, i) for a, s, i in zip(at, score.tolist(), who.tolist()) if a == k] for k in range(6)] == [sorted(x)[:3] for x in seen]


def test_scores_beyond_doubles_are_exact(spark):
    """Products above 2^53 are taken in integers; vectors whose scores a long can't hold take no part."""
    big = float(1 << 20)
    rows = [(50, [big, 1 / 256], 1), (1, [big, 3 / 256], 1), (2, [big * 0.75, 1 / 256], 2), (3, [big * 0.75, 2 / 256], 2), (4, [1e9, 1.0], 2), (5, [1e300, 1.0], 1), (6, [1.0, 1.0], 1)]
    want = plain_negatives([r for r in rows if r[0] not in (4, 5)])
    assert mined(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")) == want
    assert any(w[4] > 1 << 53 and w[5] % 2 for w in want)


# Line dedup


def plain_lines(docs, least=10):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\f\r"))
    held = {}
    for n, (_, t) in enumerate(docs):
        for x in (t or "").split("\n"):
            held.setdefault(key(x), set()).add(n)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(held[key(x)]) < least]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out, key=repr)


def found_lines(df, **more):
    got = line_dedup.drop_common_lines(df, **more)
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"], r["kept_text"]) for r in got.collect()), key=repr)


def test_lines_of_messy_documents(spark, messy, empty):
    docs = [(r["doc_id"], r["text"]) for r in rows_of(messy)]
    assert found_lines(messy) == plain_lines(docs)
    assert found_lines(messy, least_docs=2) == plain_lines(docs, 2)
    assert line_dedup.drop_common_lines(empty).count() == 0 and line_dedup.drop_common_lines(messy).count() == len(docs)
    assert set(messy.columns) <= set(line_dedup.drop_common_lines(messy).columns)


@pytest.mark.parametrize("sample", [1, 64, line_dedup.SAMPLE])
def test_common_lines_against_a_plain_loop(spark, sample):
    """A line in all documents, lines at and below the threshold, in every case and padding; long texts; copies; one document that repeats itself."""
    rng = random.Random(sample)
    pads = ["", " ", "\t", "\x0b", "\f\r", " "]
    docs = []
    for i in range(120):
        lines = [rng.choice(pads) + rng.choice(["Hot Line", "hot line", "HOT LINE"]) + rng.choice(pads)] * rng.randrange(1, 3) if i % 3 else []
        lines += [f"Shared {k}" for k in range(1, 15) if i < k * 3 and rng.random() < 0.8] + [rng.choice(["Éa", "éa", "ß", "", "  ", "\r", prose(rng, 4)]) for _ in range(rng.randrange(0, 6))]
        rng.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    docs += [(200 + i, "copied\nbody\nHot line") for i in range(9)] + [(300, "\n".join(["self"] * 40))] + [(400 + i, f"ten {i}\nin ten") for i in range(10)] + [(None, "in ten"), (None, None), (7, "in ten"), (7, "in ten")]
    docs.append((500, "\n".join(rng.choice(["hot line", "in ten", f"own {k}", f"body {k % 5}"]) for k in range(3000))))
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, row int, `kept.text` string, n_lines int").repartition(5)
    assert found_lines(df, sample=sample) == plain_lines(docs)


def test_bitmaps_name_the_lines_that_stay(spark):
    docs = [(i, f"a{i}\nsame\nb{i}") for i in range(10)] + [(10, "\n".join(f"x{k}" if k % 70 else "same" for k in range(200)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    maps = {r["text_sha256"]: r for r in line_dedup.keep_bitmaps(df).collect()}
    assert len(maps) == 11
    for _, t in docs:
        r = maps[hashlib.sha256(t.encode()).hexdigest()]
        lines = t.split("\n")
        assert (r["n_lines"], r["n_dropped"], len(r["keep"])) == (len(lines), lines.count("same"), (len(lines) + 63) // 64)
        assert [x for k, x in enumerate(lines) if r["keep"][k // 64] >> k % 64 & 1] == [x for x in lines if x != "same"]


def test_line_dedup_stays_on_the_jvm_and_ranges_hashes(spark, messy):
    seen = []
    write = line_dedup.materialize

    def watched(df, *a):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *a)

    line_dedup.materialize = watched
    try:
        out = line_dedup.drop_common_lines(messy.select("doc_id", "text"), sample=4)
        seen.append(out._jdf.queryExecution().executedPlan().toString())
    finally:
        line_dedup.materialize = write
    assert not any(re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", p) for p in seen)
    streamed = [p for p in seen if "rangepartitioning" in p]
    assert streamed and all("Window" in p and not re.search(r"hashpartitioning\(h", p) for p in streamed)
