"""Bounds, whole texts and rows without an id of their own."""

import math
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import bounded, exact_dedup, html_blocks, langid, minhash, packing, queries, ranking, sharding, token_scan, wordtok
from tests.llm.conftest import prose, rows_of
from tests.llm.handmade import PAGES


def test_bitmap_rules_out_only_what_is_absent(spark):
    df = spark.range(20_000).select("id", F.lit("x").alias("text")).unionByName(spark.sql("SELECT cast(null AS bigint) AS id, 'n' AS text"))
    marked = bounded.maybe_among(df, F.col("id"), spark.range(0, 20_000, 9))
    assert marked.where("id % 9 = 0 AND NOT maybe").count() == 0 and marked.where("id IS NULL").first()["maybe"]
    assert marked.where("id % 9 <> 0 AND maybe").count() < 200
    assert bounded.maybe_among(df, F.col("id"), spark.range(0)).where("maybe").count() == 1


def test_batches_are_bounded_by_bytes(spark):
    bounded.bound_batches(spark)
    held = int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
    assert held <= bounded.BATCH_BYTES
    bounded.bound_batches(spark, 2 * held)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == held


def test_long_texts_have_the_shingles_of_a_plain_loop(monkeypatch):
    rng = random.Random(1)
    texts = [prose(rng, 900), "w" * 5000 + " a b c d e", "", "one two"]
    whole = minhash.shingles(texts)
    signed = minhash.signatures(whole)
    monkeypatch.setattr(minhash, "STRETCH", 64)
    monkeypatch.setattr(minhash, "ELEMENTS", 50)
    cut = minhash.shingles(texts)
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(whole, cut, strict=True))
    assert (minhash.signatures(cut)[:2] == signed[:2]).all()


def test_one_of_several_equal_texts_without_an_id_stays(spark):
    rows = [(None, "a b"), (None, "a  b"), (None, "ab"), (4, "c"), (None, " c "), (None, "d")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["group_size"], r["kept"]) for r in got if r["doc_id"] is None) == [(1, True), (2, True), (3, False), (3, False), (3, True)]
    assert [(r["keep_id"], r["kept"]) for r in got if r["doc_id"] == 4] == [(None, False)]  # " c " is longer


# Language ID


def plain_buckets(text):
    padded = [ord(c) if c.isalpha() else 32 for c in f"  {text.lower()}  "] + [32, 32]
    out = []
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % (1 << 32)
        out.append(((h ^ (h >> 15)) * 0x2C1B3C6D % (1 << 32)) >> 19)
    return out


def test_trigrams_and_decoding_against_plain_loops(monkeypatch):
    rng = random.Random(8)
    texts = ["Ünï côdé, ß!", "a", "", "12 34", "".join(rng.choice("abcd é\n") for _ in range(500))]
    code = langid.codewords(4)
    w = np.random.default_rng(1)
    model = langid.LanguageModel(["aa", "bb", "cc", "dd"], code, w.normal(size=(langid.BUCKETS, code.shape[1])).astype(np.float32), w.normal(size=code.shape[1]).astype(np.float32), w.random(code.shape[1]))
    for stretch in (1 << 18, 7):
        monkeypatch.setattr(langid, "STRETCH", stretch)
        p, letters = model.scores(texts)
        for i, t in enumerate(texts):
            held = plain_buckets(t)
            assert [b for x in langid.windows(t) for b in langid.trigrams([x])[0].tolist()] == held and letters[i] == sum(c.isalpha() for c in t.lower())
            margin = [sum(float(model.weights[b, k]) for b in held) / len(held) + float(model.bias[k]) for k in range(code.shape[1])]
            loss = [sum(model.trust[k] * math.log1p(math.exp(-margin[k] * code[j, k])) for k in range(code.shape[1])) for j in range(4)]
            e = [math.exp(min(loss) - x) for x in loss]
            assert np.allclose(p[i], np.array(e) / sum(e), atol=1e-4)


def test_predictions_stand_beside_their_rows(spark, messy, empty):
    got = langid.with_language(messy, "guess")
    assert got.columns == [*messy.columns, "guess"] and got.count() == messy.count()
    own = {r["doc_id"]: r["lang_pred"] for r in langid.identify(messy).collect() if r["doc_id"] is not None}
    assert all(r["guess"] == own[r["doc_id"]] for r in got.collect() if r["doc_id"] is not None)
    assert langid.with_language(empty, "guess").count() == 0
    tied = [r["lang_pred"] for r in langid.identify(messy).where("doc_id = 7").collect()]
    assert len(tied) == 2 and len(set(tied)) == 1


# Sharding and packing


def test_shards_against_greedy_dealing(spark):
    rng = random.Random(6)
    rows = [(i if i % 4 else None, prose(rng, rng.randrange(1, 60)) if i % 3 else "the same text") for i in range(4000)]
    got = rows_of(sharding.shard_by_size(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len(t.encode()) + 1, zlib.crc32(t.encode())) for _, t in rows)
    load, slots, of = [0] * 16, {}, {}
    for r in got:
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        of.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Single documents dealt to the least loaded shard are the best that may be hoped for.
    best = [0] * 16
    for n in sorted((r["size"] for r in got), reverse=True):
        best[best.index(min(best))] += n
    assert max(load) - min(load) <= max(best) - min(best) + 0.02 * sum(load) / 16
    assert all(len(s) == 1 for crc, s in of.items() if crc != zlib.crc32(b"the same text"))


def test_special_tokens_in_texts_get_the_librarys_ids(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), wordtok.WordTokenizer(path)
    texts = ["hello <|endoftext|> world <|startoftext|>", "<|ENDOFTEXT|> x", "a<|endoftext|>b", "<|endoftext|", "é <|startoftext|> ß", "plain"]
    for a, t in zip(own.encode_all(texts), texts, strict=True):
        assert a.tolist() == lib.encode(t, add_special_tokens=False).ids, t
    pieces = packing.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    assert {p["doc_id"]: p["doc_tokens"] for p in pieces} == {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


@pytest.mark.parametrize("small", [False, True])
def test_pieces_cut_as_arrays_equal_the_librarys(small, monkeypatch):
    from tokenizers import Tokenizer

    if small:  # stretches end within texts, the cache starts anew, its table grows
        for name, n in (("STRETCH", 64), ("CACHE_WORDS", 50), ("SLOTS", 4)):
            monkeypatch.setattr(wordtok, name, n)
    path = queries.tokenizer_path("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), wordtok.WordTokenizer(path)
    rng = random.Random(21)
    alphabets = ("''sstmdrevl '!x ", "'S'T'RE'VE'M'LL'D a1", "ab'é²1. ", "ȺȾɏÀÿ×÷ªµ a\xa0\0", "abcdefghijklmnopqrst'-_ ", "aZ09 .,é ßŉǅİ́\u0085\x1c😀漢½\n\t")
    texts = ["", " ", "'", "'s", "x" * 16 + " " + "y" * 17, *("".join(rng.choice(a) for _ in range(rng.choice([1, 3, 17, 60, 400]))) for a in alphabets for _ in range(150))]
    for a, t in zip(own.encode_all(texts), texts, strict=True):
        assert a.tolist() == lib.encode(t, add_special_tokens=False).ids, t
    own.encode_all(["aa bb cc dd ee ff gg hh ii jj kk ll"])
    assert len(own._slot) >= 2 * own._known


def test_little_padding(spark, sf):
    pieces = packing.pack_documents(spark.read.parquet(f"{sf}/documents.parquet"), queries.tokenizer_path("word_bpe_49k.json")).collect()
    held = sum(p["length"] for p in pieces)
    assert held / (2048 * len({p["sequence_id"] for p in pieces})) > 0.97


# HTML


def test_hostile_markup_takes_linear_time():
    pages = {"open": "<a " * 300_000, "quotes": '<a "' * 200_000, "nested": "<div>x" * 100_000, "classes": "".join(f"<div class=k{i}>x" for i in range(30_000)), "unclosed": "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "scripts": "<script/>x" * 100_000, "comments": "<!--" * 200_000, "drawings": "<svg>x<p>y" * 50_000}
    began = time.process_time()
    cut = {name: html_blocks.blocks(p) for name, p in pages.items()}
    assert len(cut["nested"]) == 100_000 and len(cut["classes"]) == 30_000
    assert time.process_time() - began < 60
    assert len(html_blocks.default_model().label([cut["classes"]])[0]) == 30_000


def test_handmade_pages_without_an_article_element():
    right = n = 0
    model = html_blocks.default_model()
    for _, page, want in PAGES:
        own = html_blocks.blocks(page)
        assert [t for t, _, _ in own if t in want] == want
        kept = model.label([own])[0]
        right, n = right + sum(bool(k) == (t in want) for (t, _, _), k in zip(own, kept, strict=True)), n + len(own)
    assert right / n >= 0.95


# Hot digests, repeated rows, odd names


def test_equal_digests_are_numbered_by_counts(spark):
    """One digest of a third of the rows, others of a few: ranks are gapless, in the order of digests, and no piece is large."""
    rows = [(i, "g" if i % 5 else None, "aa00" if i % 3 == 0 else f"{'aa' if i % 2 else 'b'}{i % 40:02d}", i % 4 or None) for i in range(3000)]
    df = spark.createDataFrame(rows, "row long, g string, d string, t int")
    want = None
    for cell in (10, 20_000):
        for digits in (1, 2):
            got = [(r["g"], r["rank"], r["d"]) for r in ranking.rank_in_groups(df, ["g"], "d", ["t"], "rank", digits, "row", cell_rows=cell).collect()]
            assert len(got) == 3000
            for g in ("g", None):
                mine = sorted((k, d) for h, k, d in got if h == g)
                assert [k for k, _ in mine] == list(range(len(mine))) and [d for _, d in mine] == sorted(d for _, d in mine)
            want = want or sorted(got, key=repr)
            assert sorted(got, key=repr) == want


def test_the_fit_is_bounded_whatever_the_ids_and_languages(spark):
    prose_of = F.concat_ws(" ", *[F.md5(F.concat(F.col("id").cast("string"), F.lit(str(k)))) for k in range(3)])
    null_ids = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), prose_of.alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    assert langid.fit_sample(null_ids, fit_texts=300).groupBy("lang").count().collect() == langid.fit_sample(null_ids.withColumn("doc_id", F.lit(7).cast("long")), fit_texts=300).groupBy("lang").count().collect()
    assert [r["count"] for r in langid.fit_sample(null_ids, fit_texts=300).groupBy("lang").count().collect()] == [150, 150]
    same = null_ids.withColumn("text", F.lit("one text over and over"))
    assert langid.fit_sample(same).count() == 2 and langid.fit_model(same).languages == ["de", "en"]
    many = spark.range(20_000).select("id", prose_of.alias("text"), F.concat(F.lit("l"), F.col("id") % 5000).alias("lang"))
    assert langid.fit_sample(many, most_languages=100).groupBy("lang").count().count() == 100
    most = max(langid.FIT_TEXTS, langid.MOST_TEXTS, langid.MOST_LANGUAGES)
    assert langid.fit_sample(many).count() <= most and langid.fit_sample(many, fit_texts=10, most_languages=40).groupBy("lang").count().agg(F.max("count")).first()[0] <= langid.LEAST_TEXTS


def test_chunks_have_a_greatest_size():
    for text in (b"a" * 500_000, b"ab" * 300_000 + bytes(range(256)) * 40):
        cut = exact_dedup.chunks(text)
        assert b"".join(cut) == text and max(map(len, cut[:-1])) <= exact_dedup.MOST_CHUNK and len(cut[-1]) <= exact_dedup.MOST_CHUNK + exact_dedup.LEAST_CHUNK


def test_texts_without_cut_points_and_the_least_id(spark):
    rows = [(-(1 << 63), "z" * 300_000), (5, "z" * 300_000), (6, "z" * 300_001), (None, "z z"), (-(1 << 63), "zz")]
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(-(1 << 63), -(1 << 63), 2, True), (5, -(1 << 63), 2, False), (6, 6, 1, True), (None, None, 2, True), (-(1 << 63), None, 2, False)}


def test_long_token_files_are_read_by_ranges(spark, tmp_path):
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 9, 5000).astype("<u2")
    ids.tofile(tmp_path / "long.bin")
    np.array([1, 0, 2], "<u2").tofile(tmp_path / "short.bin")
    whole = token_scan.read_flat_files(spark, str(tmp_path), block_tokens=64)
    parts = token_scan.read_flat_files(spark, str(tmp_path), block_tokens=64, whole_file=1000)
    blocks = lambda df: sorted((r["file"].rsplit("/", 1)[1], r["block"], bytes(r["tokens"])) for r in df.collect())
    assert blocks(parts) == blocks(whole) and parts.count() == -(-5000 // 64) + 1
    count = lambda df: sorted((r["file"].rsplit("/", 1)[1], r["ordinal"], r["n_tokens"]) for r in token_scan.count_tokens(df, 0).collect())
    assert count(parts) == count(whole)


def test_form_fields_are_no_text():
    page = "<html><body><article><p>First words of the story.</p><textarea name=c>Write your comment here</textarea><select><option>Pick one</option></select><p>Last words.</p></article><textarea>open"
    assert [t for t, _, _ in html_blocks.blocks(page)] == ["First words of the story.", "Last words.", "open"]


def test_parts_of_a_block_are_bounded_by_bytes():
    rows = [{"rep": i, "bytes": 100 if i % 10 else 5000} for i in range(60)]
    parts = minhash._parts(rows, 8, 1000)
    for p in set(parts):
        own = [r for r, q in zip(rows, parts) if q == p]
        assert len(own) <= 8 and (sum(r["bytes"] for r in own) <= 1000 or len(own) == 1)
    assert minhash._parts(rows, 1000, None) == [0] * 60
