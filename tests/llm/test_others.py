import random
import re

import numpy as np
from pyspark.sql import functions as F

from roadlens.llm import embed_dedup, html_blocks, quotes, sql
from roadlens.llm.html_pages import made_page
from tests.conftest import same_rows
from tests.llm.conftest import rows_of

# Embeddings


def brute(vectors, threshold=0.9):
    unit = {}
    for i, v in vectors:
        x = np.array([np.nan if c is None else c for c in v], float) if v else np.zeros(0)
        if len(x) and np.isfinite(x).all() and np.abs(x).max() > 0:
            unit.setdefault(i, x / np.linalg.norm(x))
    links = {i: 0 for i, _ in vectors}
    label = {i: i for i, _ in vectors}
    near = [(i, j) for i in unit for j in unit if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
    for i, _ in near:
        links[i] += 1
    for _ in range(len(near) + 1):
        before = dict(label)
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    return {i: (links[i], label[i], label[i] == i) for i in links}


def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(1, None), (2, []), (3, [0.0] * 8), (4, [float("nan")] + [1.0] * 7), (5, [float("inf")] + [1.0] * 7), (6, [1.0, None] + [0.0] * 6), (7, [1e-30] * 8), (8, [1e30] * 8), (9, [1.0] * 8), (10, [1.0, 1.0]), (11, [1.0, 1.1]), (12, [1.0] * 8)]
    for _ in range(60):
        base = rng.normal(size=8)
        rows += [(len(rows) + 20 + k, (base + rng.normal(size=8) * 0.15).tolist()) for k in range(3)]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, unit string, rep int, cells int")
    want = brute([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    for cell, probes in ((1024, 10), (40, 6)):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near_vectors(df, cell=cell, probes=probes).collect()}
        assert got == want
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


def test_recall_over_many_cells(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(400):
        base = rng.normal(size=32)
        rows += [(len(rows), base.tolist()), (len(rows) + 1, (base + rng.normal(size=32) * 0.3).tolist())]
    want = brute(rows)
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cell=32).collect()}
    total = sum(n for n, _, _ in want.values())
    assert total > 300 and sum(got.values()) >= 0.98 * total and all(got[i] <= want[i][0] for i in got)


def test_no_link_is_lost_among_many_cells(spark):
    x = np.random.default_rng(6).normal(size=(1500, 64))
    x[:, 0] += 2.2 * 8  # a common direction: hundreds of cells are about equally near
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    label = np.arange(len(x))
    for _ in range(len(x)):
        label, before = np.where(linked, label, len(x)).min(axis=1), label
        if (label == before).all():
            break
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>"), cell=5).collect()}
    assert got == {i: (int(linked[i].sum()) - 1, int(label[i])) for i in range(len(x))} and linked.sum() > 8000


def shuffled(spark) -> int:
    """Rows that the session's stages have written to shuffles so far."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_vectors_are_not_shuffled_once_for_each_cell_they_visit(spark, monkeypatch):
    """Vectors without structure come within reach of about all 60 cells; cells of several blocks lose no link either."""
    x = np.random.default_rng(8).normal(size=(1200, 64))
    x[1::2] = x[::2] + np.random.default_rng(9).normal(size=(600, 64)) * 0.3
    want = brute(list(enumerate(x.tolist())))
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    monkeypatch.setattr(embed_dedup, "BLOCK", 8)
    before = shuffled(spark)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near_vectors(df, cell=20).collect()}
    assert got == want and sum(n for n, _, _ in want.values()) > 1000
    assert shuffled(spark) - before < 20 * len(x)


def test_hot_vector(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=16)
    rows = [(i, hot.tolist() if i % 3 == 0 else (hot + rng.normal(size=16) * 0.01).tolist() if i % 3 == 1 else rng.normal(size=16).tolist()) for i in range(2700)]
    got = rows_of(embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cell=256))
    assert all(r["component_id"] == 0 and r["n_links"] >= 1799 for r in got if r["vec_id"] % 3 < 2)


# Pages


def test_blocks_of_broken_markup():
    page = "<title>T</title><script>x='<p>no</p>'</script><body>a&amp;b <b>bo</b>ld<br>next<p>one<p>two  \n three<!-- <p>no --><ul><li>x<li>y</ul><img alt='no'>tail &eacute;&#x41;"
    assert [t for t, _, _ in html_blocks.blocks(page)] == ["T", "a&b bold next", "one", "two three", "x", "y", "tail éA"]
    assert html_blocks.blocks("") == [] and html_blocks.blocks("<<>< p") != []


def test_blocks_after_elements_without_close_tag():
    odd = ['<svg-icon name="x"></svg-icon>', '<svg class="i"/>', '<svg class="i">', "<style-guide></style-guide>", "<template>", '<math class="m"/>', "<object>", "<style/>", "<svg><title>no</title><svg>no</svg>no</svg>", "<template>no<template>no</template>no</template>"]
    for x in odd:
        page = f"<article><p>one</p>{x}<p>two</p><p>three</p></article>"
        assert [t for t, _, _ in html_blocks.blocks(page)] == ["one", "two", "three"], x
    kept = "<article><noscript>ns</noscript><object><p>ob</p></object><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math>, so</p><svg><title>no</title><foreignObject><p>fo</p></foreignObject></svg><p>end</p></article>"
    assert [t for t, _, _ in html_blocks.blocks(kept)] == ["ns", "ob", "Let x = 2, so", "fo", "end"]


def test_every_part_of_a_class_is_read():
    ((_, path, _),) = html_blocks.blocks('<div class="col-12 col-md-8 col-lg-6 mt-4 sidebar">x</div>')
    assert "sidebar" in path and "last sidebar" in path


def test_gradients_against_differences():
    model = html_blocks.BlockModel(5)
    rng = np.random.default_rng(5)
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    d = html_blocks.PATH_DIM + html_blocks.WORD_DIM + html_blocks.MEASURES
    x, mask = rng.normal(size=(5, 3, d)), np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], bool)
    y = rng.integers(0, 2, (5, 3)).astype(float)
    _, g, _ = model.gradients(x, mask, y)
    for k in ("wf", "wb", "vf", "out"):
        at = tuple(int(rng.integers(n)) for n in model.p[k].shape)
        held, losses = model.p[k][at], []
        for e in (1e-3, -1e-3):
            model.p[k][at] = held + e
            losses.append(model.gradients(x, mask, y)[0])
        model.p[k][at] = held
        assert abs((losses[0] - losses[1]) / 2e-3 - g[k][at]) < 1e-3


def test_labels_of_generated_pages():
    rng = np.random.default_rng(77)
    model, wrong, total = html_blocks.default_model(), 0, 0
    for _ in range(150):
        page, wanted = made_page(rng)
        own = html_blocks.blocks(page)
        if own:
            want = np.array([wanted(t) for t, _, _ in own])
            wrong, total = wrong + int((model.label([own])[0] != want).sum()), total + len(own)
    assert total > 2000 and wrong / total < 0.01


def test_small_fit_learns():
    rng = np.random.default_rng(78)
    model, wrong, total = html_blocks.fit_block_model(150, 2), 0, 0
    for _ in range(40):
        page, wanted = made_page(rng)
        own = html_blocks.blocks(page)
        if own:
            want = np.array([wanted(t) for t, _, _ in own])
            wrong, total = wrong + int((model.label([own])[0] != want).sum()), total + len(own)
    assert wrong / total < 0.2


def test_pages_of_the_driver(spark, sf):
    import html
    import re

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want[r["page_id"]] = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", inner))).split())
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_blocks.extract(pages).collect()}
    assert got == {k: (t, len(t)) for k, t in want.items()}


def test_messy_pages(spark):
    long = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (3, "u", "<nav><a>only</a></nav>", "x"), (4, "u", long, "x"), (4, "u", long, "x"), (None, "u", "<main><p>Some main text here, long enough.</p></main>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((repr(r["page_id"]), r["n_chars"]) for r in html_blocks.extract(df).collect())
    assert got == [("1", 0), ("2", 0), ("3", 0), ("4", 199_999), ("4", 199_999), ("None", 33)]
    assert html_blocks.extract(df.limit(0)).count() == 0


# Chats


def test_quotes_are_linked_and_removed(spark):
    rows = [
        (1, 0, "user", "Hello there\nHow are you?\n\nSecond para."), (1, 1, "assistant", "> Hello there\n> How are you?\n\nI am fine!"),
        (1, 2, "user", "On Mon, Bob wrote:\n> I am   FINE!\n>> hello there\ngreat\n\n\n\nbye"), (1, 3, "assistant", "> Second para\nok"), (1, 5, "user", None), (1, 5, "user", None),
        (None, 0, None, "x"), (2, None, "user", "> y"), (3, 0, "user", "> not found"),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, key int, depth int")
    got = {(r["conv_id"], r["turn"]): (r["content"], r["parent_turn"], r["depth"], r["n_quotes"], r["n_linked"], r["copies"]) for r in quotes.link_messages(df).collect()}
    assert got == {
        (1, 0): ("Hello there\nHow are you?\n\nSecond para.", None, 0, 0, 0, 1), (1, 1): ("I am fine!", 0, 1, 1, 1, 1), (1, 2): ("great\n\nbye", 1, 2, 2, 2, 1),
        (1, 3): ("ok", 0, 1, 1, 1, 1), (1, 5): ("", 3, 2, 0, 0, 2), (None, 0): ("x", None, 0, 0, 0, 1), (2, None): ("", None, None, 0, 0, 1), (3, 0): ("", None, 0, 1, 0, 1),
    }
    chats = {r["conv_id"]: r["chat"] for r in quotes.format_chats(df).collect()}
    assert chats[1].index("I am fine!") < chats[1].index("ok") < chats[1].index("great") and ">" not in chats[1].replace("|>", "")
    assert quotes.format_chats(df.limit(0)).count() == 0


def test_messages_of_one_turn_count_their_own_quotes(spark):
    import duckdb
    import pandas as pd

    rows = [(1, 0, "user", "first\nsecond\nthird"), (1, 1, "user", "> first\nyes"), (1, 1, "assistant", "> second\n>> nowhere\nno"), (1, 1, None, "> third"), (1, 1, "", "> third"), (1, 1, "user", "plain")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["turn"], r["role"], r["content"]): (r["n_quotes"], r["n_linked"]) for r in quotes.link_messages(df).collect()}
    assert got == {(0, "user", "first\nsecond\nthird"): (0, 0), (1, "user", "yes"): (1, 1), (1, "assistant", "no"): (2, 1), (1, None, ""): (1, 1), (1, "", ""): (1, 1), (1, "user", "plain"): (0, 0)}
    assert [(r["n_messages"], r["n_quotes"], r["n_linked"]) for r in quotes.format_chats(df).collect()] == [(6, 5, 4)]
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    same_rows(quotes.format_chats(df), con.sql(sql.OP3))


def test_quotes_equal_sql(spark):
    import duckdb
    import pandas as pd

    rng = random.Random(21)
    rows = []
    for conv in range(30):
        said: list[str] = []
        for turn in range(rng.randrange(1, 9)):
            own = [" ".join(rng.choice(["one", "Two,", "three", "FOUR!", "five"]) for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(0, 4))]
            lines = list(own)
            if said and rng.random() < 0.6:
                quoted = rng.choice(said).split("\n")
                lines = ["Le 3 mai, A a écrit :"] * (rng.random() < 0.3) + [rng.choice(["> ", ">", ">> ", "> > "]) + q for q in quoted] + ["", *own]
            said.append("\n".join(own) or "nothing")
            rows.append((conv, turn + (turn > 3), rng.choice(["user", "assistant"]), "\n".join(lines)))
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    con = duckdb.connect()
    con.register("conversations", conversations)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert quotes.link_messages(df).where("n_linked > 0").count() > 20
    same_rows(quotes.format_chats(df), con.sql(sql.OP3))


def test_long_conversation_spans_rows(spark):
    rng = random.Random(3)
    rows = [(9, i, "user", f"message {i}") for i in range(700)] + [(9, 700, "assistant", f"same turn {rng.random()}") for _ in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rows_of(quotes.chat_rows(quotes.link_messages(df), row_messages=4))
    assert sum(r["n_messages"] for r in got) == 740 and max(r["n_messages"] for r in got) < 40
    assert max(r["part"] for r in got) == 700 // 4


def test_pieces_keep_the_reply_order(spark):
    rows = [(9, 0, "user", "root")] + [(9, i, "assistant", f"> root\nanswer {i % 7} {i}") for i in range(1, 300)] + [(8, 0, "user", "short")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r for r in rows_of(quotes.chat_rows(quotes.link_messages(df), row_messages=4)) if r["conv_id"] == 9), key=lambda r: (r["part"], r["piece"]))
    assert "".join(r["chat"] for r in got) == "<|user|>\nroot<|end|>\n" + "".join(f"<|assistant|>\nanswer {i % 7} {i}<|end|>\n" for i in range(1, 300))
    assert [r["n_messages"] for r in got] == [4] * 75 and [r["piece"] for r in got] == list(range(75))


def test_long_lines_of_quote_marks_and_announcements(spark):
    marks, spaced = ">" * 1_000_000, "> " * 300_000
    texts = ["hello there", f"{marks}hello there\nyes", f"{spaced}\n\n\n{' ' * 100_000}no{' ' * 100_000}", f"On {'x' * 5000} wrote:\n> yes\nok", f"Am {'x schrieb ' * 20_000}\nfin", f"Am {'x schrieb ' * 20_000} : \nend"]
    df = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string")
    got = {r["turn"]: r for r in quotes.link_messages(df).collect()}
    assert [got[i]["content"] for i in (0, 1, 2, 3, 5)] == ["hello there", "yes", "no", "ok", "end"] and got[4]["content"] == texts[4]
    assert got[1]["n_quotes"] == 1 and got[3]["parent_turn"] == 1
    assert spark.createDataFrame([(marks,)], "t string").select(quotes.level(F.col("t"))).head()[0] == 1_000_000


def test_crowded_conversation_equals_sql(spark):
    import duckdb

    rows = [(1, i, "user", f"branch {i % 6} says {i}" if i < 6 else f"> branch {i % 6} says {i - 6}\nbranch {i % 6} says {i}") for i in range(3600)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    same_rows(quotes.format_chats(df), con.sql(sql.OP3))
    got = sorted(rows_of(quotes.format_chats(df)), key=lambda r: (r["part"], r["piece"]))
    assert len(got) > 6 and {r["part"] for r in got} == {0, 1}
    said = [int(x) for x in re.findall(r"says (\d+)\n?<\|end", "".join(r["chat"] for r in got))]
    assert all(said.index(i) > said.index(i - 6) for i in range(6, 3600, 7))
