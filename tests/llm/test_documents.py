import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from roadlens.llm import exact_dedup, langid, minhash, mixing, packing, queries, ranking, sharding, token_scan, wordtok
from tests.conftest import same_rows
from tests.llm.conftest import prose, rows_of

PATH = queries.tokenizer_path("word_bpe_49k.json")


@pytest.mark.parametrize("name", sorted(queries.llm_oracles()))
def test_query_equals_its_sql(name, spark, sf, duck):
    same_rows(queries.llm_queries()[name](spark, sf), duck.sql(queries.llm_oracles()[name]))


def test_ranks_do_not_depend_on_cells(spark):
    df = spark.range(300).selectExpr("id", "id % 3 AS g", "md5(cast(id as string)) AS d")
    got = [{(r["g"], r["id"]): r["k"] for r in ranking.rank_in_groups(df, ["g"], "d", ["id"], "k", digits).collect()} for digits in (1, 3)]
    assert got[0] == got[1]
    assert all(sorted(v for (g, _), v in got[0].items() if g == w) == list(range(100)) for w in range(3))


# Exact dedup


def test_chunks_are_cut_by_content():
    rng = random.Random(1)
    body = bytes(rng.randrange(256) for _ in range(60_000))
    one, two = exact_dedup.chunks(body), exact_dedup.chunks(b"something in front" + body)
    assert b"".join(one) == body and len(one) > 10
    assert len(set(one) & set(two)) >= len(one) - 2
    assert exact_dedup.chunks(b"") == []


def test_exact_groups_of_messy_documents(messy, empty):
    docs = [(r["doc_id"], r["text"]) for r in rows_of(messy)]
    groups: dict[str, list] = {}
    for i, t in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    want = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), float("inf") if m[0] is None else m[0]))[0]
        want += [(i, keep, len(members), i == keep, hashlib.sha256(body.encode()).hexdigest()) for i, _ in members]
    got = [tuple(r.values()) for r in rows_of(exact_dedup.exact_groups(messy))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    """With fingerprints of two bits only bytes can tell texts apart; the recipe's verification does."""
    monkeypatch.setattr(exact_dedup, "_print", lambda chunk: len(chunk) % 2)
    rng = random.Random(2)
    texts = [prose(rng, 4) for _ in range(6)]
    df = spark.createDataFrame([(i, texts[i % 6]) for i in range(12)], "doc_id long, text string")
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(exact_dedup)
    try:
        got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_groups(df).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(exact_dedup)
    assert got == {i: i % 6 for i in range(12)}


# Token counts


def test_separator_scan_against_loop(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for f in range(4):
        ids = [rng.choice([0, 5, 9, 9, 9]) for _ in range(rng.randrange(0, 200))]
        part, n = [], 0
        for x in ids:
            if x == 0:
                part.append((n, True))
                n = 0
            else:
                n += 1
        if n:
            part.append((n, False))
        want |= {(f"f{f}", k): v for k, v in enumerate(part)}
        rows += [(f"f{f}", b, np.array(ids[k : k + 7], "<u2").tobytes()) for b, k in enumerate(range(0, len(ids), 7))]
    df = spark.createDataFrame([*rows, ("none", 0, None)], "file string, block long, tokens binary")
    for run in (2, 1000):
        got = {(r["file"], r["ordinal"]): (r["n_tokens"], r["closed"]) for r in token_scan.count_tokens(df, 0, run_blocks=run).collect()}
        assert got == want


def test_flat_files(spark, tmp_path):
    np.array([1, 2, 0, 3, 0, 0, 4], "<u4").tofile(tmp_path / "a.bin")
    blocks = token_scan.read_flat_files(spark, str(tmp_path), "<u4", block_tokens=2)
    assert sorted((r["ordinal"], r["n_tokens"], r["closed"]) for r in token_scan.count_tokens(blocks, 0, "<u4").collect()) == [(0, 2, True), (1, 1, True), (2, 0, True), (3, 1, False)]


def test_token_counts_of_messy_documents(messy, empty):
    import base64

    import public_tokenizers
    import tiktoken

    ranks_path = queries.tokenizer_path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(r["doc_id"], len(coder.encode_ordinary(r["text"] or ""))) for r in rows_of(messy)]
    got = [(r["doc_id"], r["n_tokens"]) for r in token_scan.document_token_counts(messy, ranks_path, 50256).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert token_scan.document_token_counts(empty, ranks_path, 50256).count() == 0


# Language ID


def test_codewords_are_apart():
    for n in (2, 4, 5, 12):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n
        assert all((a != b).sum() >= (1 if n == 2 else 4) for i, a in enumerate(code) for b in code[:i])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(got) > 150 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_messy_documents(messy, empty):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(messy).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 14)) and got[4][0] in ("en", "de", "fr")
    assert langid.identify(empty).count() == 0
    assert {r["lang_pred"] for r in langid.identify(messy.withColumn("lang", messy["lang"].substr(9, 1).try_cast("int").cast("string"))).collect()} == {"und"}


# Sharding


def test_shards_of_skewed_documents(spark, messy, empty):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(1, 60))) for i in range(1500)] + [(2000 + i, "the same text " * 9) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(sharding.shard_by_size(df))
    sizes = [sum(r["size"] for r in got if r["shard"] == s) for s in range(16)]
    assert len(got) == 2200 and max(sizes) < 1.1 * sum(sizes) / 16 and min(sizes) > 0.9 * sum(sizes) / 16
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    text = dict(rows)
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in got)
    few = [(i, f"copy {i % 400}") for i in range(1600)]
    spread = {}
    for r in rows_of(sharding.shard_by_size(spark.createDataFrame(few, "doc_id long, text string"))):
        spread.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in spread.values())
    assert len(rows_of(sharding.shard_by_size(messy))) == messy.count() and sharding.shard_by_size(empty).count() == 0


# Packing


def test_word_tokenizer_equals_library():
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(PATH)
    own = wordtok.WordTokenizer(PATH)
    rng = random.Random(8)
    odd = "aZ09 .,!é ßŉǅİ́ \u0085\x1c😀漢²½'sLL<|endoftext|>\n\t"
    texts = ["", "It's 12 o'clock, WE'LL see", "x" * 200, "<|endoftext|>", *("".join(rng.choice(odd) for _ in range(40)) for _ in range(200)), *(prose(rng, 30) for _ in range(20))]
    for a, t in zip(own.encode_all(texts), texts, strict=True):
        assert a.tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_pricing_against_recursion():
    from functools import lru_cache

    duals = np.array([0.1, 0.15, 0.42, 0.5, 0.55, 0.95])

    @lru_cache(None)
    def best(c):
        return max([0.0, *(duals[i] + best(c - i - 1) for i in range(len(duals)) if i < c)])

    for room in (0, 1, 5, 13, 17):
        value, counts = packing.price(duals, room)
        assert abs(value - best(room)) < 1e-9 and abs((counts * duals).sum() - value) < 1e-9 and (counts * np.arange(1, 7)).sum() <= room


@pytest.mark.parametrize("seed", range(3))
def test_patterns_cover_demand(seed):
    rng = np.random.default_rng(seed)
    demand = np.zeros(64, dtype=np.int64)
    demand[:16] = rng.integers(0, 200, 16)
    plan = packing.plan_patterns(demand, 64)
    assert (sum(c * t for c, t in plan) == demand).all() and all((c * np.arange(1, 65)).sum() <= 64 for c, _ in plan)
    assert sum(t for _, t in plan) <= np.ceil((demand * np.arange(1, 65)).sum() / 64) + 3
    assert packing.plan_patterns(np.zeros(8, np.int64), 8) == []


def test_packs_of_messy_documents(messy, empty):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(PATH)
    pieces = rows_of(packing.pack_documents(messy, PATH))
    ids = [(r["doc_id"], [*lib.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in rows_of(messy)]
    assert sum(p["length"] for p in pieces) == sum(len(x) for _, x in ids)
    by_id = {i: x for i, x in ids if i is not None}
    for p in pieces:
        if p["doc_id"] is not None:
            own = by_id[p["doc_id"]]
            part = np.array(own[p["start"] : p["start"] + p["length"]], "<u4")
            assert len(part) == p["length"] and zlib.crc32(part.tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(own)
    sequences: dict[int, list] = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 2048
    assert packing.pack_documents(empty, PATH).count() == 0


# Mixing


def test_mix_of_hot_source(spark, messy, empty):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(1, 50)), "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = rows_of(mixing.mix_sources(df))
    again = {r["doc_id"]: r["taken"] for r in rows_of(mixing.mix_sources(df.repartition(9)))}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2 * 50
        assert all(r["taken"] <= 2 * r["size"] for r in own) and own[0]["source_size"] == sum(r["size"] for r in own)
    assert len(rows_of(mixing.mix_sources(messy))) == messy.count() and mixing.mix_sources(empty).count() == 0


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 1], [0, 5, 0, 7], [100, 1, 1, 1, 1, 1]])
def test_targets_against_resharing(spark, sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    left, target, open_ = 1.5 * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_ and left > 1e-9:
        w = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / w for i in open_}
        left = 0.0
        for i in sorted(open_):
            target[i] += share[i]
            if target[i] >= 2 * sizes[i]:
                left += target[i] - 2 * sizes[i]
                target[i] = 2.0 * sizes[i]
                open_.discard(i)
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert all(abs(got[f"s{i}"] - t) < 1e-6 for i, t in enumerate(target))


# Near dedup


def plain_shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    return {s: 1 + np.log(runs.count(s)) for s in set(runs)}


def plain_similarity(a, b):
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())


def test_shingles_and_similarity_against_definition():
    rng = random.Random(10)
    texts = [None, "", "a b", "A  b", prose(rng, 40), "x y z " * 30, "ß É ü ñ ó tail", prose(rng, 7)]
    texts += [texts[4] + " more words at the end", texts[5] + "q r s t u", "x y z " * 8]
    sets = minhash.shingles(texts)
    plain = [plain_shingles(t) for t in texts]
    assert [len(h) for h, _ in sets] == [len(p) for p in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            want = plain_similarity(plain[i], plain[j]) if plain[i] and plain[j] else 0.0
            assert abs(minhash.similarity(sets[i], sets[j]) - want) < 1e-9


def test_registers_estimate_similarity():
    rng = random.Random(11)
    base = prose(rng, 300).split()
    pairs = []
    for edits in (0, 3, 8, 20, 60):
        other = list(base)
        for k in rng.sample(range(300), edits):
            other[k] = "edit" + str(rng.random())
        pairs += [" ".join(base), " ".join(other)]
    sets = minhash.shingles(pairs)
    held = minhash.signatures(sets)
    for k in range(0, len(pairs), 2):
        assert abs((held[k] == held[k + 1]).mean() - minhash.similarity(sets[k], sets[k + 1])) < 0.17


def components(n, links):
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_near_groups_against_brute_force(spark):
    rng = random.Random(12)
    texts = []
    shared = prose(rng, 25)
    for _ in range(8):
        base = prose(rng, 120).split()
        for _ in range(6):
            other = list(base)
            for k in rng.sample(range(120), rng.randrange(0, 8)):
                other[k] = "w" + str(rng.randrange(10**6))
            texts.append(" ".join(other))
    texts += [shared + " " + prose(rng, 6) for _ in range(25)] + [prose(rng, 80) for _ in range(10)]
    rng.shuffle(texts)
    plain = [plain_shingles(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if plain_similarity(plain[i], plain[j]) >= 0.8]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == components(len(texts), links)


def test_blocks_find_what_pivots_miss(spark, monkeypatch):
    """A bucket larger than a block whose members link to few pivots."""
    from pyspark import cloudpickle

    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", 1)
    cloudpickle.register_pickle_by_value(minhash)
    rng = random.Random(13)
    base = prose(rng, 150).split()
    texts = []
    for _ in range(40):
        other = list(base)
        for k in rng.sample(range(150), 3):
            other[k] = "w" + str(rng.randrange(10**6))
        texts.append(" ".join(other))
    plain = [plain_shingles(t) for t in texts]
    links = [(i, j) for i in range(40) for j in range(i) if plain_similarity(plain[i], plain[j]) >= 0.8]
    try:
        got = {r["doc_id"]: r["class_id"] for r in minhash.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(minhash)
    assert [got[i] for i in range(40)] == components(40, links)


@pytest.mark.parametrize(("many", "tests"), [(1024, 2), (0, 4)])
def test_another_pivot_is_tried_where_the_rest_is_large(spark, monkeypatch, many, tests):
    """Few comparisons are left to the blocks: no round of tests, each a dozen shuffles, for them."""
    rng = random.Random(13)
    base = prose(rng, 150).split()
    texts = []
    for _ in range(40):
        other = list(base)
        for k in rng.sample(range(150), 3):
            other[k] = "w" + str(rng.randrange(10**6))
        texts.append(" ".join(other))
    plain = [plain_shingles(t) for t in texts]
    links = [(i, j) for i in range(40) for j in range(i) if plain_similarity(plain[i], plain[j]) >= 0.8]
    calls, tested = [], minhash._tested
    monkeypatch.setattr(minhash, "MANY", many, raising=False)
    monkeypatch.setattr(minhash, "_tested", lambda *a: calls.append(1) or tested(*a))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(40)] == components(40, links)
    assert len(calls) == tests


def test_near_groups_of_messy_documents(messy, empty):
    got = [(r["doc_id"], r["class_id"], r["kept"]) for r in minhash.near_groups(messy).collect()]
    classes = {i: c for i, c, _ in got}
    assert len(got) == messy.count() and classes[9] == 8 and classes[11] == 10 and classes[7] == 4 and classes[1] == 1 and classes[3] == 3
    assert minhash.near_groups(empty).count() == 0
