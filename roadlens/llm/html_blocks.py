"""Main text of web pages by a recurrent block labeller.

A page is cut to leaf blocks in page order. Every block is read as the hashed tokens
of its tag path (tags, classes, ids), its hashed words and a few measures; a
bidirectional LSTM, in numpy, labels each block with the whole page as context. The
model is fitted here, from a fixed seed, on generated pages whose labels are known.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path as File
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.bounded import bound_batches
from roadlens.llm.wordhash import word_hashes

PATH_BUCKETS, WORD_BUCKETS, PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 2048, 1024, 24, 4, 6, 24
#: Pages generated for the fit, and rounds over them.
FIT_PAGES, FIT_ROUNDS = 3600, 6
#: Blocks labelled at once; path buckets summed at once.
STRETCH, PATHS = 4096, 1 << 16

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile(r"""[>"']""")
#: Script and style hold raw text, up to their close tag or the end of the page; self-closed without a close tag they are empty.
_RAW = re.compile(r"<(script|style)(?=[\s/>])", re.I)
_RAW_CLOSE = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in ("script", "style")}
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Formulas stand in the line; a space goes before each of their parts.
_MATH = frozenset("annotation maction math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
_INLINE |= _MATH
#: Drawings and their parts have no content where they are self-closed.
_DRAWN = frozenset("animate circle ellipse g image line path polygon polyline rect stop svg symbol text tspan use".split())
#: Elements with a close tag whose content isn't text of the page: drawings, templates, and form fields with what they suggest.
_HIDDEN = ("svg", "template", "textarea", "select", "datalist")
_UNSHOWN = re.compile(rf"<(?:{'|'.join(_HIDDEN)})[\s/>]", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new one of the kind closes, up to the element that holds them.
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDS = frozenset("article aside blockquote body div dl fieldset footer form header main nav ol section table td ul".split())
_ENDS_P = _HOLDS | frozenset("h1 h2 h3 h4 h5 h6 hr pre address figure details tr".split())


#: Tags that leave a drawing that is still open.
_LEAVES = _ENDS_P | frozenset("b big br center code dd dt em embed h1 i img li p span strong sub sup tr u".split())


class Tokens:
    """Cuts a page to (kind, name or text, attributes) in time linear in it, however broken the markup is."""

    def __init__(self, page: str):
        self.page = page
        self._last = {c: page.rfind(c) for c in "<>\"'"}
        self._dead: set[int] = set()  # places outside quotes from which no tag ends
        self._close = {n: (-1, -1) for n in _RAW_CLOSE}

    def _end_of(self, begin: int) -> int:
        """Where the tag whose attributes begin here has its ``>``: the first outside quotes, or the first of all where quotes don't pair."""
        page, at, seen = self.page, begin, []
        while at not in self._dead:
            m = _QUOTE_OR_END.search(page, at)
            if m is None:
                break
            if m[0] == ">":
                return m.start()
            seen.append(at)
            if self._last[m[0]] <= m.start():
                break
            at = page.index(m[0], m.end()) + 1
        self._dead.update(seen)
        return page.find(">", begin)

    def _raw_close(self, name: str, begin: int) -> int:
        """Where the next whole close tag of a raw element ends, or -1: looked up once for each."""
        found, end = self._close[name]
        if found < begin and (end >= 0 or found == -1):
            m = _RAW_CLOSE[name].search(self.page, begin)
            end = self.page.find(">", m.end()) if m else -1
            self._close[name] = found, end = (m.start(), end) if m and end >= 0 else (len(self.page), -1)
        return end

    def __iter__(self) -> Iterator[tuple[int, str, str]]:
        page, at, n = self.page, 0, len(self.page)
        while at < n:
            if page[at] != "<":
                end = page.find("<", at) if at < self._last["<"] else n
                yield TEXT, page[at:end], ""
                at = end
                continue
            closed = None
            for opens, closes in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
                if page.startswith(opens, at):
                    end = page.find(closes, at + len(opens))
                    closed = n if end < 0 else end + len(closes)
                    break
            if closed is None and at < self._last[">"] and (m := _NAME.match(page, at)):
                end = self._end_of(m.end())
                if raw := _RAW.match(page, at):
                    past = self._raw_close(raw[1].lower(), end + 1)
                    closed = past + 1 if past >= 0 else end + 1 if page[end - 1] == "/" else n
                    yield RAW, "", ""
                else:
                    closed = end + 1
                    yield CLOSE if page[at + 1] == "/" else OPEN, m[1].lower(), page[m.end() : end]
            if closed is None:
                yield TEXT, "<", ""
                closed = at + 1
            at = closed


TEXT, OPEN, CLOSE, RAW = range(4)


def _unshown(tokens: list[tuple[int, str, str]]) -> dict[int, int]:
    """For each open tag of a closed drawing, template or form field: the token to go on with. One without a close tag hides nothing."""
    past: dict[int, int] = {}
    opened: dict[str, list[int]] = {tag: [] for tag in _HIDDEN}
    left: dict[int, int] = {}
    for i, (kind, tag, attrs) in enumerate(tokens):
        if kind not in (OPEN, CLOSE):
            continue
        if tag in opened:
            if kind == CLOSE:
                if opened[tag]:
                    k = opened[tag].pop()
                    past[k] = left.pop(k, i + 1)
            elif tag != "svg" or not attrs.endswith("/"):
                opened[tag].append(i)
        elif opened["svg"] and tag in _LEAVES:
            for k in reversed(opened["svg"]):
                if k in left:
                    break
                left[k] = i
    return past


def _marks(attrs: str) -> tuple[str, ...]:
    found = []
    for kind, *values in _MARKS.findall(attrs):
        found += [p.lower() for v in values if v for p in _PARTS.findall(v)]
    return tuple(found)


class Path(NamedTuple):
    """Buckets of the tags, classes, ids and roles of all elements on a path, and of those of its last one, told apart by "last"."""

    whole: tuple[int, ...] = ()
    own: tuple[int, ...] = ()

    def __contains__(self, token: object) -> bool:
        return _bucket(str(token)) in self.whole + self.own


class _Open:
    """The open elements, with what has to be known about them kept up to date: no step looks through all of them."""

    def __init__(self):
        self.tags: list[str] = []
        self._marks: list[tuple[str, ...] | None] = []  # of an element without marks in the line, which is no part of a path: None
        self._at: dict[str, list[int]] = {}
        self._solid, self._holding, self._on_path = [-1], [-1], []
        self._count = Counter()
        self._path: tuple[int, ...] | None = ()

    def last(self, tag: str) -> int:
        held = self._at.get(tag)
        return held[-1] if held else -1

    def links(self) -> int:
        return len(self._at.get("a", ()))

    def push(self, tag: str, marks: tuple[str, ...]) -> None:
        k = len(self.tags)
        self.tags.append(tag)
        self._at.setdefault(tag, []).append(k)
        if tag not in _INLINE:
            self._solid.append(k)
        if tag in _HOLDS:
            self._holding.append(k)
        shown = tag not in _INLINE or bool(marks)
        self._marks.append(marks if shown else None)
        if shown:
            self._on_path.append(k)
            for t in (f"<{tag}>", *marks):
                b = _bucket(t)
                self._count[b] += 1
                if self._count[b] == 1:
                    self._path = None

    def cut(self, k: int) -> None:
        """Closes the k-th element and all within it."""
        while len(self.tags) > k:
            tag, marks, at = self.tags.pop(), self._marks.pop(), len(self.tags)
            self._at[tag].pop()
            for held in (self._solid, self._holding, self._on_path):
                if held and held[-1] == at:
                    held.pop()
            for t in (f"<{tag}>", *marks) if marks is not None else ():
                b = _bucket(t)
                self._count[b] -= 1
                if not self._count[b]:
                    del self._count[b]
                    self._path = None

    def close(self, tag: str) -> None:
        k = self.last(tag)
        if k >= 0 and (tag not in _INLINE or k > self._solid[-1]):
            self.cut(k)

    def make_room(self, ends: tuple[str, ...]) -> None:
        """Closes the last element of ``ends``, unless it is outside the last one that holds others."""
        k = max(map(self.last, ends))
        if k >= 0 and k >= self._holding[-1]:
            self.cut(k)

    def path(self) -> Path:
        if self._path is None:
            self._path = tuple(self._count)
        if not self._on_path:
            return Path(self._path)
        k = self._on_path[-1]
        return Path(self._path, (_bucket(f"last<{self.tags[k]}>"), *(_bucket(f"last {m}") for m in self._marks[k])))


def blocks(page: str) -> list[tuple[str, Path, float]]:
    """(text, path, share of characters in links) of every leaf block with text, in page order."""
    out: list = []
    stack, text = _Open(), []
    path: Path | None = None
    linked = 0

    def flush() -> None:
        nonlocal text, path, linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                out.append((joined, path or Path(), min(1.0, linked / len(joined))))
        text, path, linked = [], None, 0

    tokens: Iterable[tuple[int, str, str]] = Tokens(page)
    past: dict[int, int] = {}
    if _UNSHOWN.search(page):
        tokens = list(tokens)
        past = _unshown(tokens)
    resume = 0
    for at, (kind, tag, attrs) in enumerate(tokens):
        if at < resume:
            continue
        if at in past:
            resume = past[at]
            text.append(" ")
            continue
        if kind == TEXT:
            if path is None and not tag.isspace():
                path = stack.path()
            text.append(tag)
            if stack.links():
                linked += len(tag)
            continue
        if kind == RAW or tag == "br" or tag == "svg" or tag in _VOID and tag not in _INLINE and tag != "hr":
            text.append(" ")
            continue
        if tag not in _INLINE:
            flush()
        elif tag in _MATH and kind == OPEN:
            text.append(" ")
        if tag in _VOID:
            continue
        if kind == CLOSE:
            stack.close(tag)
            continue
        ends = _CLOSES.get(tag, ()) or (("p",) if tag in _ENDS_P else ())
        if ends:
            stack.make_room(ends)
        if not attrs.endswith("/") or tag not in _DRAWN and tag not in _MATH:
            stack.push(tag, _marks(attrs) if "=" in attrs else ())
    flush()
    return out


@lru_cache(maxsize=1 << 16)
def _bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % PATH_BUCKETS


def features(page_blocks: list) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(path buckets of each block, word buckets end to end, words up to each block's end, measures)."""
    n = len(page_blocks)
    paths: list[np.ndarray] = []
    held: dict[int, tuple[frozenset, np.ndarray]] = {}  # blocks under the same elements share one array
    for _, path, _ in page_blocks:
        if id(path.whole) not in held:
            held[id(path.whole)] = frozenset(path.whole), np.array(sorted(path.whole) or [0], dtype=np.int16)
        own, array = held[id(path.whole)]
        paths.append(array if own.issuperset(path.own) else np.array(sorted(own.union(path.own)), dtype=np.int16))
    words, ends = word_hashes([t for t, _, _ in page_blocks])
    sizes = np.array([len(t) for t, _, _ in page_blocks], dtype=np.float32)
    measures = np.stack(
        [
            np.log1p(sizes) / 6,
            np.array([share for _, _, share in page_blocks], dtype=np.float32),
            np.arange(n, dtype=np.float32) / max(1, n - 1),
            np.array([t[-1] in ".!?:;\"'" for t, _, _ in page_blocks], dtype=np.float32),
            sizes / max(1.0, sizes.sum()),
            np.log1p(np.diff(ends, prepend=0).astype(np.float32)) / 4,
        ],
        axis=1,
    ).astype(np.float32)
    return paths, (words % np.uint64(WORD_BUCKETS)).astype(np.int64), ends, measures


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockModel:
    """Embedded bags and measures -> LSTM forwards and backwards -> one logit a block."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + MEASURES
        r = lambda *s, scale: (rng.normal(size=s) * scale).astype(np.float32)
        # What the fit never meets stays near zero, and so says next to nothing.
        self.p = {"path": r(PATH_BUCKETS, PATH_DIM, scale=0.02), "word": r(WORD_BUCKETS, WORD_DIM, scale=0.02), "out": r(2 * HIDDEN + d, scale=0.1), "bias": np.zeros(1, np.float32)}
        for k in ("f", "b"):
            self.p[f"w{k}"] = r(d + HIDDEN, 4 * HIDDEN, scale=0.15)
            self.p[f"v{k}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)

    def inputs(self, f) -> np.ndarray:
        paths, words, ends, measures = f
        place: dict[int, int] = {}
        at = [place.setdefault(id(x), len(place)) for x in paths]
        distinct = list({id(x): x for x in paths}.values())
        n = np.array([len(x) for x in distinct])
        ends_at = np.cumsum(n)
        parts, k = [], 0
        while k < len(distinct):  # PATHS buckets at a time
            e = max(k + 1, int(np.searchsorted(ends_at, ends_at[k] - n[k] + PATHS, side="right")))
            parts.append(np.add.reduceat(self.p["path"][np.concatenate(distinct[k:e])], ends_at[k:e] - n[k:e] - (ends_at[k] - n[k]), axis=0))
            k = e
        path = (np.concatenate(parts) / np.sqrt(n)[:, None])[at]
        held = np.diff(ends, prepend=0)
        padded = np.concatenate([self.p["word"][words].cumsum(axis=0, dtype=np.float64), np.zeros((1, WORD_DIM))]) if len(words) else np.zeros((1, WORD_DIM))
        upto = np.where((ends > 0)[:, None], padded[np.maximum(ends, 1) - 1], 0)
        word = np.diff(upto, axis=0, prepend=0) / np.maximum(held, 1)[:, None]
        return np.concatenate([path, word, measures], axis=1).astype(np.float32)

    def _lstm(self, x: np.ndarray, mask: np.ndarray, k: str, keep: bool):
        """x: time, batch, size. Steps beyond a page's end leave its state alone."""
        w, v = self.p[f"w{k}"], self.p[f"v{k}"]
        steps = range(len(x)) if k == "f" else range(len(x) - 1, -1, -1)
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        out, kept = np.zeros((*x.shape[:2], HIDDEN), np.float32), []
        fed = x @ w[: x.shape[2]] + v
        for t in steps:
            z = fed[t] + h @ w[x.shape[2] :]
            i, f, o, g = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN : 2 * HIDDEN]), _sigmoid(z[:, 2 * HIDDEN : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            c2 = f * c + i * g
            s = np.tanh(c2)
            m = mask[t][:, None]
            if keep:
                kept.append((t, h, c, i, f, o, g, s))
            h, c = np.where(m, o * s, h), np.where(m, c2, c)
            out[t] = h
        return out, kept

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        f, kf = self._lstm(x, mask, "f", keep)
        b, kb = self._lstm(x, mask, "b", keep)
        both = np.concatenate([f, b, x], axis=2)
        return both @ self.p["out"] + self.p["bias"], (both, kf, kb)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray):
        """(mean loss, gradient of each weight, gradient of x)."""
        z, (both, kf, kb) = self.logits(x, mask, keep=True)
        n = max(1, mask.sum())
        p = _sigmoid(z)
        loss = -(np.where(y > 0, np.log(p + 1e-9), np.log(1 - p + 1e-9)) * mask).sum() / n
        dz = ((p - y) * mask / n).astype(np.float32)
        g = {"out": np.tensordot(dz, both, axes=([0, 1], [0, 1])), "bias": dz.sum(keepdims=True).reshape(1)}
        dboth = dz[:, :, None] * self.p["out"]
        dx = dboth[:, :, 2 * HIDDEN :].copy()
        d = x.shape[2]
        for k, kept, at in (("f", kf, 0), ("b", kb, HIDDEN)):
            w = self.p[f"w{k}"]
            dw, dv = np.zeros_like(w), np.zeros_like(self.p[f"v{k}"])
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, gg, s in reversed(kept):
                m = mask[t][:, None]
                whole = dh + dboth[t, :, at : at + HIDDEN]
                do = whole * s
                dcell = dc + whole * o * (1 - s * s)
                dzt = np.concatenate([dcell * gg * i * (1 - i), dcell * c * f * (1 - f), do * o * (1 - o), dcell * i * (1 - gg * gg)], axis=1) * m
                dw[:d] += x[t].T @ dzt
                dw[d:] += h.T @ dzt
                dv += dzt.sum(axis=0)
                dx[t] += dzt @ w[:d].T
                dh = np.where(m, dzt @ w[d:].T, whole)
                dc = np.where(m, dcell * f, dc)
            g[f"w{k}"], g[f"v{k}"] = dw, dv
        return loss, g, dx

    def label(self, pages: list[list]) -> list[np.ndarray]:
        """Whether each block of each page is main text."""
        out: list = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        k = 0
        while k < len(order):
            e = k + 1
            while e < len(order) and (e + 1 - k) * len(pages[order[e]]) <= STRETCH:
                e += 1
            part = [self.inputs(features(pages[i])) for i in order[k:e]]
            x, mask = _pad(part)
            z, _ = self.logits(x, mask)
            for j, i in enumerate(order[k:e]):
                out[i] = z[: len(pages[i]), j] > 0
            k = e
        return out


def _pad(part: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in part)
    x, mask = np.zeros((longest, len(part), part[0].shape[1]), np.float32), np.zeros((longest, len(part)), dtype=bool)
    for j, p in enumerate(part):
        x[: len(p), j], mask[: len(p), j] = p, True
    return x, mask


def fit_block_model(n_pages: int = FIT_PAGES, rounds: int = FIT_ROUNDS, seed: int = 1) -> BlockModel:
    """Trains on generated pages; the same seed gives the same model."""
    from roadlens.llm.html_pages import made_page

    rng = np.random.default_rng(seed)
    model, sets = BlockModel(seed), []
    for _ in range(n_pages):
        page, wanted = made_page(rng)
        own = blocks(page)
        if own:
            sets.append((features(own), np.array([wanted(t) for t, _, _ in own], dtype=np.float32)))
    m = {k: np.zeros_like(w) for k, w in model.p.items()}
    v = {k: np.zeros_like(w) for k, w in model.p.items()}
    step = 0
    for turn in range(rounds):
        order = sorted(rng.permutation(len(sets)).tolist(), key=lambda i: len(sets[i][1]) // 8)
        batches = [order[k : k + 48] for k in range(0, len(order), 48)]
        for b in rng.permutation(len(batches)).tolist():
            part = [sets[i] for i in batches[b]]
            x, mask = _pad([model.inputs(f) for f, _ in part])
            y = np.zeros(mask.shape, np.float32)
            for j, (_, labels) in enumerate(part):
                y[: len(labels), j] = labels
            _, g, dx = model.gradients(x, mask, y)
            g["path"], g["word"] = np.zeros_like(model.p["path"]), np.zeros_like(model.p["word"])
            for j, ((paths, words, ends, _), labels) in enumerate(part):
                n = np.array([len(p) for p in paths])
                np.add.at(g["path"], np.concatenate(paths), np.repeat(dx[: len(labels), j, :PATH_DIM] / np.sqrt(n)[:, None], n, axis=0))
                held = np.diff(ends, prepend=0)
                np.add.at(g["word"], words, np.repeat(dx[: len(labels), j, PATH_DIM : PATH_DIM + WORD_DIM] / np.maximum(held, 1)[:, None], held, axis=0))
            step += 1
            rate = 0.01 if turn < rounds - 1 else 0.003
            for k, w in model.p.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                w -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)
    return model


#: What ``python -m roadlens.llm.html_blocks`` wrote: the weights that ``fit_block_model()`` gives, in half precision.
WEIGHTS = File(__file__).with_name("block_model.npz")


@lru_cache(maxsize=1)
def default_model() -> BlockModel:
    """The stored model; fitted anew, in about a minute, where the file is missing."""
    if not WEIGHTS.exists():
        return fit_block_model()
    model = BlockModel()
    with np.load(WEIGHTS) as held:
        model.p = {k: held[k].astype(np.float32) for k in held.files}
    return model


def main_text(page_blocks: list, kept: np.ndarray) -> str:
    return " ".join(t for (t, _, _), k in zip(page_blocks, kept, strict=True) if k)


def extract(pages: DataFrame, model: BlockModel | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars and n_blocks of every page.

    The whole html is read; null and empty pages, and pages without a block of main
    text, give an empty text. Repeated rows are returned each, an empty table gives
    none; other columns are ignored.
    """
    bound_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                cut = [blocks(h) if h else [] for h in part.column(2).to_pylist()]
                texts = [main_text(b, m) for b, m in zip(cut, shared.value.label(cut), strict=True)]
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in cut], pa.int64())],
                    names=["page_id", "url", "text", "n_chars", "n_blocks"],
                )

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")


if __name__ == "__main__":
    np.savez_compressed(WEIGHTS, **{k: w.astype(np.float16) for k, w in fit_block_model().p.items()})
