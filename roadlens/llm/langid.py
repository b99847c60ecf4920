"""Language identification by error-correcting output codes.

Every learned language has a codeword; one linear classifier over hashed character
trigrams predicts each bit. A text's bits are decoded to the codeword with the least
loss, each bit weighted by how well its classifier tells the training texts apart.
A close second codeword flags the text as ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roadlens.llm.bounded import bound_batches
from roadlens.session import materialize

BUCKETS = 1 << 13
#: Labelled texts that the classifiers are fitted on: so many in all, dealt evenly to the languages. Where that leaves
#: less than LEAST_TEXTS for each, LEAST_TEXTS are taken, as long as that gives no more than MOST_TEXTS in all.
FIT_TEXTS, LEAST_TEXTS, MOST_TEXTS = 2400, 24, 24_000
#: Languages that are learned at most: the most frequent ones.
MOST_LANGUAGES = 512
#: Below this score the decision is flagged as ambiguous.
CLEAR_SCORE = 0.6
UNKNOWN = "und"
#: Characters handled at once; longer texts are handled in stretches that overlap, so that no trigram is lost or added.
STRETCH = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter, else 32."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


def windows(text: str) -> Iterator[str]:
    """The text in lower case between two spaces at either end, in stretches of STRETCH characters and the two that follow them."""
    padded = f"  {text.lower()}  "
    for k in range(0, len(padded), STRETCH):
        n = min(STRETCH, len(padded) - k)
        yield padded[k : k + n + 2].ljust(n + 2)


def trigrams(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each trigram of every window end to end, where each window starts, letters of each)."""
    size = np.array([len(p) - 2 for p in parts], dtype=np.int64)
    points = _letters()[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    own = np.ones(len(points), dtype=bool)
    ends = np.cumsum(size + 2)
    own[ends - 1] = own[ends - 2] = False
    starts = np.cumsum(size) - size
    letters = np.add.reduceat((points[own] != 32).astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    h = points * np.uint32(0x9E3779B1)
    h[:-1] += points[1:] * np.uint32(0x85EBCA77)
    h[:-2] += points[2:] * np.uint32(0xC2B2AE3D)
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(19)).astype(np.int64)[own], starts, letters


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1: every split of the languages for up to 5, else well-separated random words."""
    if n <= 5:
        cols = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(cols, dtype=np.float32).reshape(-1, n).T
    rng, bits, best, far = np.random.default_rng(7), 10 * math.ceil(math.log2(n)), None, -1
    for _ in range(50):
        words = rng.choice(np.array([-1, 1], dtype=np.float32), (n, bits))
        gap = int(((bits - words @ words.T) / 2 + bits * np.eye(n)).min())
        if gap > far and (np.abs(words.sum(axis=0)) < n).all():
            best, far = words, gap
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(probability of every language for each text, letters of each text)."""
        sums, count, letters = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
        todo: list[tuple[int, str]] = []
        room = 0

        def flush() -> None:
            at, starts, n = trigrams([t for _, t in todo])
            who = np.array([i for i, _ in todo])
            if len(at):
                np.add.at(sums, who, np.add.reduceat(self.weights[at], starts, axis=0))
                np.add.at(count, who, np.diff(np.append(starts, len(at))))
                np.add.at(letters, who, n)

        for i, text in enumerate(texts):
            for window in windows(text):
                todo.append((i, window))
                room += len(window)
                if room >= STRETCH:
                    flush()
                    todo, room = [], 0
        if todo:
            flush()
        margin = sums / np.maximum(count, 1)[:, None] + self.bias
        # Loss-weighted decoding: logistic loss of each bit against each codeword.
        loss = (np.logaddexp(0, -margin[:, None, :] * self.code[None]) * self.trust).sum(axis=2)
        p = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        return p / p.sum(axis=1, keepdims=True), letters


def fit_sample(docs: DataFrame, fit_texts: int = FIT_TEXTS, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """(lang, digest) of the texts that are fitted: of each learned language those of the least hashes, equal ones once.

    The most frequent ``most_languages`` languages are learned, ties by name, from an even
    share of ``fit_texts`` each; where that is less than LEAST_TEXTS, from so many, as
    long as MOST_TEXTS allow it. So there are at most the greatest of ``fit_texts``,
    MOST_TEXTS and ``most_languages`` rows, whatever the ids, texts and languages.
    """
    labelled = _labelled(docs)
    counts = materialize(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages))
    n_languages = max(1, counts.count())
    quota = max(1, fit_texts // n_languages, min(LEAST_TEXTS, MOST_TEXTS // n_languages))
    # Hashes beyond eight times the share that is needed are left where they are; the rest is counted exactly.
    share = F.pmod("digest", F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = labelled.join(F.broadcast(counts), "lang").where(share * F.col("n") < 8 * quota)
    distinct = drawn.groupBy("lang", "digest").agg(F.lit(1).alias("one"))
    least = Window.partitionBy("lang").orderBy(F.pmod("digest", F.lit(1 << 30)), "digest")
    return distinct.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= quota).select("lang", "digest")


def _labelled(docs: DataFrame) -> DataFrame:
    own = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    return own.withColumn("digest", F.xxhash64("text", F.lit("fit")))


def fit_model(docs: DataFrame, fit_texts: int = FIT_TEXTS, seed: int = 11, most_languages: int = MOST_LANGUAGES) -> LanguageModel | None:
    """Learns from the non-null ``lang`` of ``docs`` (text, lang); None if there is none.

    The texts fitted are those of ``fit_sample``; their whole texts count, ids don't.
    """
    sample = materialize(fit_sample(docs, fit_texts, most_languages))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()  # of the sample's digests: a text that is repeated is counted once a task
        for batch in batches:
            for lang, digest, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (lang, digest) in seen:
                    continue
                seen.add((lang, digest))
                held = np.zeros(BUCKETS, dtype=np.int64)
                for window in windows(text):
                    held += np.bincount(trigrams([window])[0], minlength=BUCKETS)
                at = np.flatnonzero(held)
                packed = [at.astype("<i4").tobytes(), (held[at] / held.sum()).astype("<f4").tobytes()]
                yield pa.record_batch([pa.array([lang]), pa.array([digest], pa.int64()), *(pa.array([x], pa.binary()) for x in packed)], names=["lang", "digest", "at", "share"])

    # As many rows as the sample has, at most, are broadcast and collected.
    chosen = _labelled(docs).join(F.broadcast(sample), ["lang", "digest"]).select("lang", "digest", "text")
    rows = chosen.mapInArrow(count, "lang string, digest long, at binary, share binary").dropDuplicates(["lang", "digest"]).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["digest"]))
    languages = sorted({r["lang"] for r in rows})
    code = codewords(len(languages))
    if len(languages) == 1:
        return LanguageModel(languages, np.ones((1, 1), np.float32), np.zeros((BUCKETS, 1), np.float32), np.full(1, 20.0), np.ones(1))
    held = [(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["share"], "<f4")) for r in rows]
    total, squares = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at, share in held:
        total[at] += share
        squares[at] += share.astype(np.float64) ** 2
    spread = np.sqrt(np.maximum(squares / len(rows) - (total / len(rows)) ** 2, 0))
    scale = (1 / (spread + 0.1 / BUCKETS)).astype(np.float32)

    def dense(which) -> np.ndarray:
        """The texts' scaled shares: only those of a step are ever held dense."""
        x = np.zeros((len(which), BUCKETS), dtype=np.float32)
        for i, k in enumerate(which):
            x[i, held[k][0]] = held[k][1] * scale[held[k][0]]
        return x

    place = {k: i for i, k in enumerate(languages)}
    y = code[[place[r["lang"]] for r in rows]]
    rng = np.random.default_rng(seed)
    bits = code.shape[1]
    w, b = np.zeros((BUCKETS, bits), np.float32), np.zeros(bits, np.float32)
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    for epoch in range(12):
        order = rng.permutation(len(rows))
        for k in range(0, len(rows), 128):
            xs, ys = dense(order[k : k + 128]), y[order[k : k + 128]]
            z = np.clip(ys * (xs @ w + b), -30, 30)
            g = -ys / (1 + np.exp(z)) / len(xs)
            t += 1
            gw = xs.T @ g + 1e-4 * w
            m = 0.9 * m + 0.1 * gw
            v = 0.999 * v + 0.001 * gw * gw
            w -= 0.01 / (1 + epoch) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
            b -= 0.05 * g.sum(axis=0)
    right = np.zeros(bits)
    for k in range(0, len(rows), 128):
        which = np.arange(k, min(k + 128, len(rows)))
        right += ((dense(which) @ w + b) * y[which] > 0).sum(axis=0)
    right /= len(rows)
    trust = np.maximum(0.05, 2 * right - 1)
    return LanguageModel(languages, code, (w * scale[:, None]).astype(np.float32), b, trust)


def predictions(model: LanguageModel | None, texts: list[str | None]) -> tuple[list, list, list, list]:
    """(language, score, second language, whether it is ambiguous) of every text."""
    names, score, second, unclear = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts), [True] * len(texts)
    if model and texts:
        p, letters = model.scores([t or "" for t in texts])
        for i in np.flatnonzero(letters > 0).tolist():
            order = np.argsort(-p[i], kind="stable")
            names[i], score[i] = model.languages[order[0]], float(p[i, order[0]])
            second[i] = model.languages[order[1]] if len(order) > 1 else None
            unclear[i] = score[i] < CLEAR_SCORE
    return names, score, second, unclear


def predict_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score, lang_second, ambiguous of every whole text.

    A text that is null, empty or has no letter is ``und`` with score 0, as is every
    text where nothing could be learned. Of languages with the same score the first by
    name is told. Repeated rows are predicted each, alike; an empty table gives no rows.
    Other columns are never read.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, second, unclear = predictions(shared.value, batch.column(1).to_pylist())
            yield pa.record_batch(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(second, pa.string()), pa.array(unclear, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "lang_second", "ambiguous"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(predict, "doc_id long, lang_pred string, score double, lang_second string, ambiguous boolean")


def with_language(docs: DataFrame, out: str, fit_texts: int = FIT_TEXTS) -> DataFrame:
    """``docs`` with a column ``out`` of the predicted language: rows are read once and never joined or shuffled.

    Learns as ``identify`` does; where nothing could be learned, a text with letters has
    null. The other columns pass through unread.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit_model(docs.where(~held_out()), fit_texts))
    text = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            found = predictions(shared.value, texts)[0] if shared.value else [None if any(map(str.isalpha, t or "")) else UNKNOWN for t in texts]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.string())], names=[*names, "found"])

    schema = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema, strict=True)] + [StructField("found", StringType())])
    return docs.toDF(*names).mapInArrow(add, schema).toDF(*docs.columns, out)


def held_out():
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, fit_texts: int = FIT_TEXTS) -> DataFrame:
    """Learns from the labelled documents that aren't held out and predicts every document.

    As ``predict_languages``, with held_out; a null doc_id isn't held out. Labels that
    differ on equal texts are each learned from.
    """
    model = fit_model(docs.where(~held_out()), fit_texts)
    return predict_languages(docs, model).withColumn("held_out", held_out())
