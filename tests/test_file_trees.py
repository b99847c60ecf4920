"""The layout writer and the header probe, against files of all kinds."""

import hashlib
import os
import re
import struct
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roadlens.operators import stats, validate
from roadlens.sources import file_tree, folders, headers, images, yolo
from tests.test_sources import png

ITEMS = "split string, target_name string, content binary, lines array<string>"


def items(spark, n=40):
    rows = [("train" if i % 3 else "val", f"s{i % 7}__img_{i}.png", bytes([i]) * (i * 50 + 1), [f"0 0.5 0.5 0.{i % 9 + 1} 0.2"] * (i % 3)) for i in range(n)]
    return rows, spark.createDataFrame(rows, ITEMS).repartition(4)


def seen(root) -> list[str]:
    """What a reader finds; a task that is still stopping may hold the job's hidden folder."""
    return [x for x in os.listdir(root) if not x.startswith(".")]


def tree(root) -> dict[str, bytes]:
    return {str(p.relative_to(root)): p.read_bytes() for p in Path(root).rglob("*") if p.is_file()}


def test_written_layout_is_read_back(spark, tmp_path):
    rows, df = items(spark)
    out = str(tmp_path / "set")
    told = {r["target"]: r["bytes"] for r in file_tree.write_layout(df, out).collect()}
    want = {f"images/{s}/{n}": c for s, n, c, _ in rows} | {f"labels/{s}/{n[:-4]}.txt": "".join(f"{x}\n" for x in lines).encode() for s, n, _, lines in rows}
    found = {k: v for k, v in tree(out).items() if not k.startswith("manifest/")}
    assert found == want and told == {k: len(v) for k, v in want.items()}
    assert {r["target"]: r["md5"] for r in file_tree.read_tree(spark, out).collect()} == {k: hashlib.md5(v).hexdigest() for k, v in want.items()}
    assert {(r["split"], r["file_name"], r["length"]) for r in images.list_images(spark, f"{out}/images").collect()} == {(s, n, len(c)) for s, n, c, _ in rows}
    texts = {(r["split"], r["stem"]): [x for x in r["body"].split("\n") if x] for r in yolo.read_labels(spark, f"{out}/labels").collect()}
    assert texts == {(s, n[:-4]): lines for s, n, _, lines in rows}
    assert os.listdir(tmp_path) == ["set"]
    with pytest.raises(FileExistsError):
        file_tree.write_layout(df, out)
    file_tree.write_layout(df.where("split = 'val'"), out, overwrite=True)
    assert {k for k in tree(out) if k.startswith("images/")} == {f"images/val/{n}" for s, n, _, _ in rows if s == "val"} and os.listdir(tmp_path) == ["set"]


def test_a_dry_run_and_an_empty_table(spark, tmp_path):
    rows, df = items(spark, 6)
    told = {r["target"]: r["bytes"] for r in file_tree.write_layout(df, str(tmp_path / "x"), dry_run=True).collect()}
    assert len(told) == 12 and not os.listdir(tmp_path)
    assert file_tree.write_layout(df.limit(0), str(tmp_path / "none")).count() == 0 and os.path.isdir(tmp_path / "none")


def test_a_failed_or_killed_task_leaves_nothing(spark, tmp_path):
    _, df = items(spark)
    for bad in ("../out.png", "/etc/x", "a//b", "manifest/x", "", None):
        files = file_tree.layout_files(df).unionByName(spark.createDataFrame([(bad, b"x")], "target string, content binary"))
        with pytest.raises(Exception, match="not a path below"):
            file_tree.write_tree(files, str(tmp_path / "set"))
        assert not seen(tmp_path), bad

    def killed(batches):
        for k, batch in enumerate(batches):
            yield batch
        os._exit(9)

    with pytest.raises(Exception):
        file_tree.write_tree(file_tree.layout_files(df).coalesce(2).mapInArrow(killed, "target string, content binary"), str(tmp_path / "set"))
    assert not seen(tmp_path)


def test_an_attempt_that_was_lost_is_not_published(spark, tmp_path):
    """What a lost attempt left in the job's folder goes with the commit; a file that no task tells of stops it."""
    w = file_tree.FileTreeWriter(str(tmp_path / "set"), False)
    (Path(w.job) / "_attempts/lost").mkdir(parents=True)
    (Path(w.job) / "_attempts/lost/0").write_bytes(b"half")
    (Path(w.job) / "images/train").mkdir(parents=True)
    (Path(w.job) / "images/train/a.png").write_bytes(b"whole")
    with pytest.raises(ValueError, match="are there"):
        w.commit([file_tree.Written(0, 0)])
    w.commit([file_tree.Written(1, 5), None])
    assert tree(tmp_path / "set") == {"images/train/a.png": b"whole"}


def test_a_written_dataset_is_read_by_its_manifest(spark, tmp_path):
    """No folder is listed: what isn't in the manifest isn't there, and filters on split reach its parts."""
    png(tmp_path / "one.png", 12, 8)
    content = (tmp_path / "one.png").read_bytes()
    df = spark.createDataFrame([("train" if i % 2 else "val", f"i{i}.png", content, []) for i in range(9)], ITEMS).repartition(3)
    file_tree.write_layout(df, str(tmp_path / "set"))
    (tmp_path / "set/images/train/stray.png").write_bytes(content)
    reader = headers.HeaderReader(f"{tmp_path}/set/images")
    assert [p.files for p in reader.partitions()] == [[]] * 3 and all(p.part.endswith(".json") for p in reader.partitions())
    own = headers.read_headers(spark, f"{tmp_path}/set")
    assert sorted((r["split"], r["file_name"], r["width"], r["length"]) for r in own.collect()) == sorted(("train" if i % 2 else "val", f"i{i}.png", 12, len(content)) for i in range(9))
    assert own.where("split = 'train'").count() == 4 and yolo.read_labels(spark, f"{tmp_path}/set/labels").where("split = 'val' AND body = ''").count() == 5


def test_a_name_that_is_taken_is_told_by_the_task(tmp_path):
    store, job = file_tree.opened(str(tmp_path))
    for name, data in (("a", b"same"), ("b", b"same"), ("c", b"else"), ("d", b"sane")):
        (tmp_path / name).write_bytes(data)
    file_tree.FileTreeWriter._placed(store, f"{job}/a", f"{job}/b")
    assert sorted(os.listdir(tmp_path)) == ["b", "c", "d"]
    with pytest.raises(ValueError, match="several files"):
        file_tree.FileTreeWriter._placed(store, f"{job}/d", f"{job}/b")


def test_collisions_are_findings(spark, tmp_path):
    rows = [("train", "a.jpg", b"1", []), ("train", "a.png", b"2", ["0 0 0 0 0"]), ("val", "a.png", b"3", []), ("val", "b.png", b"3", []), ("val", "b.png", b"4", None)]
    df = spark.createDataFrame(rows, ITEMS)
    found = sorted((r["split"], r["file"], r["rule"]) for r in file_tree.collisions(file_tree.layout_files(df)).collect())
    assert found == [("train", "a.txt", "T16"), ("val", "b.png", "T16")]
    with pytest.raises(ValueError, match="labels/train/a.txt"):
        file_tree.write_layout(df.where("split = 'train'"), str(tmp_path / "set"))
    # Past the check, the commit itself counts the files.
    with pytest.raises(Exception, match="are there|several files have"):
        file_tree.write_tree(file_tree.layout_files(df), str(tmp_path / "set"))
    assert not seen(tmp_path)


def test_backgrounds_and_negatives(spark, tmp_path):
    own = spark.createDataFrame([("train", "s1", "a.png", b"1", ["0 0 0 0 0"])], "split string, seq_id string, file_name string, content binary, lines array<string>")
    bg = spark.createDataFrame([("val", "n.jpg", b"22")], "split string, file_name string, content binary")
    file_tree.write_layout(file_tree.merged_items(own, bg), str(tmp_path / "set"))
    assert {k: v for k, v in tree(tmp_path / "set").items() if k[0] in "il"} == {"images/train/s1__a.png": b"1", "labels/train/s1__a.txt": b"0 0 0 0 0\n", "images/val/bg__n.jpg": b"22", "labels/val/bg__n.txt": b""}
    mined = spark.createDataFrame([("priority", "a.jpg", b"1"), ("generic", "a.jpg", b"2"), ("excluded", "a.jpg", b"3")], "category string, file_name string, content binary")
    file_tree.write_negatives(mined, str(tmp_path / "neg"))
    assert {k: v for k, v in tree(tmp_path / "neg").items() if k[0] in "pg"} == {"priority/attain_a.jpg": b"1", "generic/attain_a.jpg": b"2"}
    with pytest.raises(ValueError):
        file_tree.write_negatives(mined.unionByName(mined), str(tmp_path / "twice"))


# Headers


def jpeg(spark, path, w, h, exif=b"", before=b"") -> bytes:
    jvm = spark._jvm
    picture = jvm.java.awt.image.BufferedImage(w, h, 1)
    for x in range(w):
        picture.setRGB(x, x % h, 255 * x)
    path.parent.mkdir(parents=True, exist_ok=True)
    assert jvm.javax.imageio.ImageIO.write(picture, "jpg", jvm.java.io.File(str(path)))
    data = path.read_bytes()
    part = lambda mark, body: bytes([0xFF, mark]) + struct.pack(">H", len(body) + 2) + body
    data = data[:2] + before + (part(0xE1, b"Exif\0\0" + exif) if exif else b"") + data[2:]
    path.write_bytes(data)
    return data


def exif(order: str, value: int, others: int = 0) -> bytes:
    entry = lambda tag, v: struct.pack(f"{order}HHIHH", tag, 3, 1, v, 0)
    return {"<": b"II*\0", ">": b"MM\0*"}[order] + struct.pack(f"{order}IH", 8, others + 1) + b"".join(entry(0x100 + k, 9) for k in range(others)) + entry(0x0112, value) + bytes(4)


@pytest.fixture(scope="module")
def pictures(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pictures")
    png(root / "images/train/a.png", 40, 30)
    png(root / "images/train/b.PNG", 1, 200)
    jpeg(spark, root / "images/train/c.jpg", 33, 21)
    jpeg(spark, root / "images/train/turned.JPEG", 50, 20, exif(">", 6))
    jpeg(spark, root / "images/val/little.jpg", 20, 50, exif("<", 8, 3))
    # A frame far behind the head: large segments are skipped, not read.
    jpeg(spark, root / "images/val/far.jpg", 64, 32, exif(">", 3), before=(b"\xff\xe2" + struct.pack(">H", 65_000) + bytes(64_998)) * 20 + b"\xff\xff\xff")
    whole = (root / "images/train/a.png").read_bytes()
    (root / "images/val/cut.png").write_bytes(whole[:-5])
    (root / "images/val/badcrc.png").write_bytes(whole[:20] + b"\x07" + whole[21:])
    (root / "images/val/cut.jpg").write_bytes((root / "images/train/c.jpg").read_bytes()[:-40])
    for name, data in (("none.png", b""), ("text.jpg", b"hello"), ("soi.jpg", b"\xff\xd8"), ("scan.jpg", b"\xff\xd8\xff\xda\0\4aa\xff\xd9")):
        (root / "images/val" / name).write_bytes(data)
    (root / "images/val/note.txt").write_text("x")
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    (root / "images/test").mkdir()
    (root / "images/test/exif.png").write_bytes(whole[:33] + chunk(b"eXIf", exif("<", 5)) + whole[33:])
    return root


def test_sizes_equal_the_decoders(spark, pictures):
    got = {r["file_name"]: r for r in headers.read_headers(spark, str(pictures)).collect()}
    decoded = {r["file_name"]: (r["width"], r["height"]) for r in images.decode_images(spark, f"{pictures}/images").where("readable").collect()}
    readable = {n: (r["width"], r["height"]) for n, r in got.items() if r["readable"]}
    assert set(readable) == {"a.png", "b.PNG", "c.jpg", "turned.JPEG", "little.jpg", "far.jpg", "exif.png"}
    assert all(decoded[n] == size for n, size in readable.items())
    assert {n: r["orientation"] for n, r in got.items() if r["orientation"] != 1} == {"turned.JPEG": 6, "little.jpg": 8, "far.jpg": 3, "exif.png": 5}
    assert all((r["width"], r["height"]) == (-1, -1) for n, r in got.items() if n not in readable) and len(got) == 14
    shown = {r["file_name"]: (r["shown_width"], r["shown_height"]) for r in headers.shown_size(headers.read_headers(spark, str(pictures))).collect()}
    assert shown["turned.JPEG"] == (20, 50) and shown["far.jpg"] == (64, 32) and shown["exif.png"] == (30, 40)
    assert got["far.jpg"]["length"] > 1_300_000 and got["far.jpg"]["bytes_read"] < 6000
    assert {(r["stem"], r["ext"], r["split"]) for r in got.values()} >= {("turned", ".JPEG", "train"), ("exif", ".png", "test")}


def test_filters_on_split_are_pushed(spark, pictures):
    one = headers.read_headers(spark, str(pictures)).where("split = 'train' AND width > 1")
    assert sorted(r["file_name"] for r in one.collect()) == ["a.png", "c.jpg", "turned.JPEG"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Filter [^\n]*split", plan) and re.search(r"Filter[^\n]*width", plan)
    assert headers.read_headers(spark, str(pictures)).where("split IN ('val', 'test')").count() == 10
    assert headers.read_headers(spark, str(pictures)).where("split = 'nowhere'").count() == 0
    reader = headers.HeaderReader(f"{pictures}/images", headers.PART_BYTES)
    reader.splits = {"train"}
    assert [(p.split, len(p.files)) for p in reader.partitions()] == [("train", 4)]
    reader.part_bytes = 2 * folders.OPEN_COST
    assert [len(p.files) for p in reader.partitions()] == [2, 2]


def test_headers_feed_checks_and_histograms(spark, pictures):
    own = headers.read_headers(spark, str(pictures))
    found = {r["file"] for r in validate.validate(own, spark.createDataFrame([], "split string, stem string, body string")).where("rule = 'V2'").collect()}
    assert found == {"cut.png", "badcrc.png", "cut.jpg", "none.png", "text.jpg", "soi.jpg", "scan.jpg"}
    assert stats.resolution_histogram(own.where("readable"), first=None).agg(F.sum("n")).first()[0] == 7


def test_probed_contents_equal_probed_files(spark, pictures):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{pictures}/images").select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "content").where("name <> 'note.txt'")
    got = {r["name"]: (r["format"], r["width"], r["orientation"], r["readable"]) for r in headers.probe_contents(files, "name").collect()}
    # Spark's binary reader passes over files without a byte.
    assert got == {r["file_name"]: (r["format"], r["width"], r["orientation"], r["readable"]) for r in headers.read_headers(spark, str(pictures)).where("length > 0").collect()}
    assert headers.probe_contents(files.select("name", F.lit(None).alias("content")), "name").where("readable").count() == 0
