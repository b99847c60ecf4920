"""The version log, counters of the writing pass, and the fingerprint's resampling."""

import numpy as np
import pytest

from roadlens import sinks
from roadlens.functions import fingerprint
from roadlens.versions import Conflict, Dataset


def paths(df):
    return sorted(r["path"] for r in df.collect())


def test_versions_follow_each_other(spark, tmp_path):
    set_ = Dataset(spark, str(tmp_path / "set"))
    assert set_.latest() is None and set_.versions() == []
    with pytest.raises(FileNotFoundError):
        set_.read()
    rows = spark.createDataFrame([(f"p{i}", i) for i in range(6)], "path string, n int")
    assert set_.commit(rows, message="merged", facts={"seed": 42}) == 0 and paths(set_.read()) == [f"p{i}" for i in range(6)]
    lost = spark.createDataFrame([("p1",), ("p4",), ("nowhere",)], "path string")
    dry = {(r["path"], r["change"]) for r in set_.remove(lost, 0, dry_run=True).collect()}
    assert dry == {("p1", "removed"), ("p4", "removed")} and set_.versions() == [0]
    assert {(r["path"], r["change"]) for r in set_.remove(lost, 0, "deduplicated").collect()} == dry
    assert paths(set_.read()) == ["p0", "p2", "p3", "p5"] and len(paths(set_.read(0))) == 6
    told = set_.about(1)
    assert (told["parent"], told["rows"], told["message"]) == (0, 4, "deduplicated") and set_.about(0)["facts"] == {"seed": 42}
    assert {(r["path"], r["change"]) for r in set_.changed(set_.read(1), set_.read(0)).collect()} == {("p1", "added"), ("p4", "added")}
    with pytest.raises(ValueError, match="no version 7"):
        set_.commit(rows, 7)


def test_of_two_writers_one_wins(spark, tmp_path):
    one, two = Dataset(spark, str(tmp_path / "set")), Dataset(spark, str(tmp_path / "set"))
    rows = spark.createDataFrame([("a",), ("b",)], "path string")
    one.commit(rows)
    base = two.latest()
    assert one.commit(rows.limit(1), base) == 1
    with pytest.raises(Conflict):
        two.commit(rows.where("path = 'b'"), base)
    with pytest.raises(Conflict):
        two.commit(rows)
    assert one.versions() == [0, 1] and paths(one.read()) == ["a"]
    assert len(list((tmp_path / "set/lists").iterdir())) == 2 and not [p for p in (tmp_path / "set/log").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_threads_that_commit_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    Dataset(spark, str(tmp_path / "set")).commit(spark.createDataFrame([("a",)], "path string"))

    def change(k):
        try:
            return Dataset(spark, str(tmp_path / "set")).commit(spark.createDataFrame([(f"w{k}",)], "path string"), 0)
        except Conflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(change, range(4)))
    assert sorted(got, key=str) == [1, None, None, None]
    assert paths(Dataset(spark, str(tmp_path / "set")).read()) == [f"w{got.index(1)}"]


def test_clean_removes_what_no_version_names(spark, tmp_path):
    set_ = Dataset(spark, str(tmp_path / "set"))
    number = None
    for k in range(4):
        number = set_.commit(spark.createDataFrame([(f"v{k}",)], "path string"), number)
    (tmp_path / "set/lists/left-by-a-lost-writer").mkdir()
    names = [set_.about(n)["list"] for n in range(4)]
    assert set_.clean(keep=2) == sorted([*names[:2], "left-by-a-lost-writer"]) and set_.versions() == [2, 3]
    assert paths(set_.read(2)) == ["v2"] and set_.commit(spark.createDataFrame([("x",)], "path string"), 3) == 4
    with pytest.raises(ValueError):
        set_.clean(0)


def test_findings_are_counted_as_they_are_written(spark, tmp_path):
    rows = [("E", "V3"), ("W", "V4"), ("E", "V5")]
    df = spark.createDataFrame(rows, "level string, rule string")
    assert sinks.write_findings(df, str(tmp_path / "f")) == {"errors": 2, "warnings": 1, "passed": False}
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "f")).collect()) == sorted(rows)
    assert sinks.write_findings(df.where("level = 'W'"), str(tmp_path / "g"))["passed"]
    assert sinks.write_findings(df.limit(0), str(tmp_path / "h")) == {"errors": 0, "warnings": 0, "passed": True}


def plain_resized(grey, side):
    """One point after the other, in floating point."""

    def along(x):
        n, out = x.shape[1], []
        scale = n / side
        wide = max(scale, 1)
        for i in range(side):
            c, total, weight = (i + 0.5) * scale, 0.0, 0.0
            for k in range(max(0, int(c - 3 * wide + 0.5)), min(n, int(c + 3 * wide + 0.5))):
                t = (k + 0.5 - c) / wide
                w = 1.0 if t == 0 else 0.0 if abs(t) >= 3 else 3 * np.sin(np.pi * t) * np.sin(np.pi * t / 3) / (np.pi * t) ** 2
                total, weight = total + w * x[:, k], weight + w
            out.append(np.clip(np.floor(total / weight + 0.5), 0, 255))
        return np.stack(out, axis=1)

    return along(along(grey.astype(float)).T).T


@pytest.mark.parametrize("shape", [(48, 64), (7, 200), (32, 90)])
def test_resampling_against_a_plain_loop(shape):
    grey = np.random.default_rng(3).integers(0, 256, shape)
    assert np.abs(fingerprint._resized(grey, 32) - plain_resized(grey, 32)).max() <= 1
    flat = np.full((*shape, 3), 90, np.uint8)
    assert (fingerprint._resized(flat[..., 0], 32) == 90).all()


def test_small_changes_move_few_bits():
    rng = np.random.default_rng(5)
    base = np.cumsum(np.cumsum(rng.normal(size=(120, 160, 3)), axis=0), axis=1)
    base = ((base - base.min()) / np.ptp(base) * 255).astype(np.uint8)
    own = fingerprint.phash(base)
    apart = lambda x: bin((own ^ fingerprint.phash(x)) & (1 << 64) - 1).count("1")
    assert apart(np.clip(base.astype(int) + rng.integers(-3, 4, base.shape), 0, 255).astype(np.uint8)) <= 6
    assert apart(base[::2, ::2]) <= 6 and apart(rng.integers(0, 256, base.shape, dtype=np.uint8)) > 15
    assert fingerprint.phash(np.full((5, 5), 3, np.uint8)) == fingerprint.phash(np.full((50, 9, 1), 3, np.uint8))
