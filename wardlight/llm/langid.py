"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed runs of one to three characters of the lower-cased text, in which all that
is no letter is one space; a feature's value is its share of the text's runs times its inverse
document frequency, counted over all documents that may be learned from. Weights are learned by
follow-the-regularised-leader with an elastic-net penalty on at most about `PER_LANGUAGE`
documents of each language (fewer each beyond `LANGUAGES` languages, all of which are kept), in `SHARDS` shards that Spark trains side by side and averages. A
temperature, fitted on labelled documents that the weights never saw, calibrates the shares.

Defined cases: a null text and a text without a letter are `und` with score 0; so is every text
if nothing can be learned; of equal scores the language first in order wins; documents without
a lang are predicted but not learned from; repeated rows get equal rows; an empty table gives
no rows; only doc_id, text and lang are read, lang and doc_id only to choose what is learned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import held_out, id_and_text, pieces, text_key, text_of

#: Bounds on what is fitted: labelled documents of a language, for up to so many languages; more share the same total.
PER_LANGUAGE, LANGUAGES = 5_000, 200
BITS, ORDERS, SHARDS, ROUNDS = 16, (1, 2, 3), 4, 3
ALPHA, BETA, L1, L2, SCALE = 0.5, 1.0, 1e-4, 1e-4, 30.0
UND = "und"
_PIECE = 256 << 10
U = np.uint64
_BUCKETS = 1 << BITS


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, times the inverse document frequency
    bias: np.ndarray
    temperature: float = 1.0


@cache
def _letters() -> np.ndarray:
    """True for the code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every run of characters, and which texts hold a letter."""
    flat = [f" {(t or '').lower()} " for t in texts]
    codes = np.frombuffer("".join(flat).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(flat)), np.fromiter(map(len, flat), np.int64, len(flat)))
    letter = _letters()[codes]
    lettered = np.zeros(len(flat), bool)
    lettered[text[letter]] = True
    keep = np.ones(len(codes), bool)
    keep[1:] = letter[1:] | letter[:-1] | (text[1:] != text[:-1])
    codes, text = np.where(letter, codes, 0x20)[keep].astype(U), text[keep]
    buckets, where = [], []
    for n in ORDERS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        h = codes[:size] + U(n << 32)
        for j in range(1, n):
            h = h * U(0x9E3779B97F4A7C15) + codes[j : size + j]
        inside = text[:size] == text[n - 1 :]
        buckets.append(((h * U(0xD6E8FEB86659FD93)) >> U(64 - BITS)).astype(np.int64)[inside])
        where.append(text[:size][inside])
    return np.concatenate(buckets), np.concatenate(where), lettered


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of the partition each bucket occurs."""
    counts = np.zeros(_BUCKETS, np.int64)
    texts = 0
    for batch in batches:
        for part in pieces(batch, limit=_PIECE):
            bucket, text, _ = runs(part.column("text").to_pylist())
            texts += part.num_rows
            for at in range(0, part.num_rows, 64):
                rows = (text >= at) & (text < at + 64)
                seen = np.zeros((64, _BUCKETS), bool)
                seen[text[rows] - at, bucket[rows]] = True
                counts += seen.sum(axis=0)
    at = np.flatnonzero(counts)
    yield pa.record_batch([pa.array([-1, *at.tolist()], pa.int64()), pa.array([texts, *counts[at].tolist()], pa.int64())], names=["bucket", "n"])


def _features(idf: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, limit=_PIECE):
                at, values = [], []
                for t in part.column("text").to_pylist():
                    bucket, _, _ = runs([t])
                    n = np.bincount(bucket, minlength=_BUCKETS)
                    own = np.flatnonzero(n)
                    at.append(own.astype(np.int32))
                    values.append((SCALE * idf[own] * n[own] / len(bucket)).astype(np.float32))
                yield pa.record_batch([part.column("part"), part.column("lang"), part.column("order"), pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], names=["part", "lang", "order", "at", "values"])

    return run


class Ftrl:
    """Follow-the-regularised-leader for softmax regression, one step for each text."""

    def __init__(self, languages: int):
        self.z, self.n = np.zeros((_BUCKETS + 1, languages)), np.zeros((_BUCKETS + 1, languages))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def step(self, at: np.ndarray, values: np.ndarray, language: int) -> None:
        w = self.weights(at)
        logits = values @ w
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[language] -= 1
        g = values[:, None] * p[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _train(languages: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    place = {x: i for i, x in enumerate(languages)}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("order", kind="stable")
        model = Ftrl(len(languages))
        data = [(np.append(a, _BUCKETS), np.append(v, 1.0), place[x]) for a, v, x in zip(rows["at"], rows["values"], rows["lang"], strict=True)]
        for _ in range(ROUNDS):
            for at, values, language in data:
                model.step(at, values, language)
        w = model.weights(np.arange(_BUCKETS + 1))
        at, language = np.nonzero(w)
        return pd.DataFrame({"bucket": at, "language": language, "w": w[at, language]})

    return run


def logits_of(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Logits of each text before the temperature, and which texts hold a letter."""
    bucket, text, lettered = runs(texts)
    sizes = np.bincount(text, minlength=len(texts))
    starts = np.cumsum(np.concatenate([[0], sizes]))[:-1]
    # Runs come order by order; sorted by text each text's runs lie together.
    order = np.argsort(text, kind="stable")
    sums = np.add.reduceat(model.weights[bucket[order]], starts, axis=0) if len(texts) else np.zeros((0, len(model.languages)))
    return SCALE * sums / sizes[:, None] + model.bias, lettered


def _predict(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UND], object)
        for batch in batches:
            for part in pieces(batch, limit=_PIECE):
                if not model.languages:
                    best, score = np.zeros(part.num_rows, int), np.zeros(part.num_rows)
                else:
                    logits, lettered = logits_of(part.column("text").to_pylist(), model)
                    p = np.exp((logits - logits.max(axis=1, keepdims=True)) / model.temperature)
                    p /= p.sum(axis=1, keepdims=True)
                    best = np.where(lettered, p.argmax(axis=1), len(model.languages))
                    score = np.where(lettered, p.max(axis=1), 0.0)
                yield pa.record_batch([part.column("doc_id"), part.column("text_key"), pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "text_key", "lang_pred", "score"])

    return run


def _logits(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, limit=_PIECE):
                logits, _ = logits_of(part.column("text").to_pylist(), model)
                yield pa.record_batch([part.column("lang"), pa.array(list(logits), pa.list_(pa.float64()))], names=["lang", "logits"])

    return run


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least loss, by golden-section search over its logarithm.

    One wrong label more than was seen is reckoned with, else texts told apart perfectly would
    drive the temperature to zero.
    """
    wrong = 1 / (len(truth) + 2)

    def loss(x: float) -> float:
        scaled = logits / np.exp(x)
        top = scaled.max(axis=1)
        return float((top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)) - (1 - wrong) * scaled[np.arange(len(truth)), truth] - wrong * scaled.mean(axis=1)).mean())

    low, high, part = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """What comes to the driver: one row per bucket and language, and the logits of the calibration texts."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    sizes = {r["lang"]: r["count"] for r in own.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((_BUCKETS, 0), np.float32), np.zeros(0))
    counted = {r["bucket"]: r["n"] for r in own.select("text").mapInArrow(_count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    texts = counted.pop(-1, 0)
    df = np.zeros(_BUCKETS)
    df[list(counted)] = list(counted.values())
    idf = np.log((1 + texts) / (1 + df)) + 1
    order = F.xxhash64("doc_id", "text")
    per_language = min(per_language, per_language * LANGUAGES / len(languages))
    limit = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, max(1, int(min(1.0, per_language / n) * (1 << 20))))])
    chosen = own.withColumn("order", order).filter(F.pmod(F.xxhash64(F.lit("sample"), "order"), F.lit(1 << 20)) < F.element_at(limit, F.col("lang")))
    # One in four of the chosen is kept from the weights for the temperature.
    chosen = chosen.withColumn("part", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 3, -1).otherwise(F.pmod("order", F.lit(SHARDS))).cast("int"))
    features = chosen.filter("part >= 0").select("part", "lang", "order", "text").mapInArrow(_features(idf), "part int, lang string, order bigint, at array<int>, values array<float>")
    trained = features.groupBy("part").applyInPandas(_train(languages), "bucket int, language int, w double")
    weights = np.zeros((_BUCKETS + 1, len(languages)))
    for r in trained.groupBy("bucket", "language").agg((F.sum("w") / SHARDS).alias("w")).toLocalIterator():
        weights[r["bucket"], r["language"]] = r["w"]
    model = Model(languages, (weights[:-1] * idf[:, None]).astype(np.float32), weights[-1])
    seen = chosen.filter("part < 0").select("lang", "text").mapInArrow(_logits(model), "lang string, logits array<double>").toPandas()
    if len(seen):
        model.temperature = temperature(np.array(seen.logits.tolist()), seen.lang.map({x: i for i, x in enumerate(languages)}).to_numpy())
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_key, lang_pred and score of every row."""
    return id_and_text(docs).withColumn("text_key", text_key()).mapInArrow(_predict(model), "doc_id bigint, text_key bigint, lang_pred string, score double")
