import re
import zlib

import pytest

import corpus_pipeline
from roadlens.session import materialize
from tests.llm.test_documents import plain_shingles, plain_similarity


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf))
        out.append(docs)
    return out


def test_stages_against_plain_python(spark, sf, stages):
    every = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    named, exact, near, mixed, _ = ([(r["doc_id"], r["text"]) for r in s.collect()] for s in [*stages[:4], stages[3]])
    assert sorted(i for i, _ in named) == sorted(i for i, r in every.items() if any(c.isalpha() for c in r["text"] or ""))
    groups: dict[str, list] = {}
    for i, t in named:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i))
    assert sorted(i for i, _ in exact) == sorted(min(g)[1] for g in groups.values())
    sets = {i: plain_shingles(t) for i, t in exact}
    places: dict = {}
    for i, s in sets.items():
        for x in s:
            places.setdefault(x, []).append(i)
    label = {i: i for i in sets}
    pairs = {(a, b) for p in places.values() if len(p) < 60 for a in p for b in p if a < b}
    links = [(a, b) for a, b in pairs if plain_similarity(sets[a], sets[b]) >= 0.8]
    for _ in range(20):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert sorted(i for i, _ in near) == sorted(i for i, c in label.items() if i == c)
    kept = {i for i, _ in near}
    assert {i for i, _ in mixed} <= kept and max(sum(i == j for j, _ in mixed) for i in {i for i, _ in mixed}) <= 2
    words = lambda rows: sum(len(t.split()) for _, t in rows)
    assert abs(words(mixed) - 1.5 * words(near)) < 0.2 * words(near)


def test_stages_keep_columns_and_pack_all(stages):
    assert all(s.columns == ["doc_id", "text", "lang", "source", "n_chars"] for s in stages[:4])
    pieces = stages[4].collect()
    per_row = {}
    for r in stages[3].collect():
        per_row[r["doc_id"]] = per_row.get(r["doc_id"], 0) + 1
    starts = {}
    for p in pieces:
        starts.setdefault(p["doc_id"], []).append(p)
    assert {i: sum(p["start"] == 0 for p in ps) for i, ps in starts.items()} == per_row
    assert all(sum(p["length"] for p in ps) == ps[0]["doc_tokens"] * per_row[i] for i, ps in starts.items())


def test_stages_meet_messy_and_empty_documents(spark, sf, messy, empty):
    for start in (messy, empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, sf))
            if name != "packing":
                assert docs.columns == start.columns
        assert (docs.count() == 0) == (start is empty)


def test_rows_without_an_id_of_their_own_have_their_own_decisions(spark, sf):
    rows = [(None, None), (None, "12345 67890"), *[(None, f"orphan number{i} speaks of thing{i} and place{i}") for i in range(6)], (None, "orphan number3 speaks of thing3 and place3")]
    rows += [(5, "five says one thing"), (5, "five says quite another story"), (6, "five says one thing"), (7, "7 7 7"), (7, "seven has letters here")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    lettered = sorted((repr(i), t) for i, t in rows if any(c.isalpha() for c in t or ""))
    want = sorted({(i, t) for i, t in lettered if i != "6"})
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = materialize(stage(spark, docs, sf))
        got = sorted((repr(r["doc_id"]), r["text"]) for r in docs.collect())
        if name == "mixing":
            assert set(got) <= set(want) and max(got.count(x) for x in got) <= 2
        else:
            assert got == (lettered if name == "language_id" else want), name


def test_columns_of_any_name_pass_through(spark, sf):
    rows = [(i, f"document {i % 5} tells of thing{i % 5} and place{i % 5}", None, "a", 3, {"x": i}, i, f"`{i}`", i, i) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `meta.n` map<string,int>, `a b` int, `quo``te` string, _row int, _LANG int")
    names, n = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf))
        n.append(docs.count())
        assert name == "packing" or docs.columns == names, name
    assert n[:2] == [12, 5] and n[-1] >= 1
