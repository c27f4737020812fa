"""Toxic passages: maximum-scoring segments of token log-odds with extreme-value calibration.

Fit, on at most about `most` labelled documents that may be learned from, each text once:
1. log-odds of every token between toxic and other documents with an informative Dirichlet
   prior (the token's share in both classes, as heavy as the smaller class); tokens whose
   z-score is below `least_z` are neutral, and the `vocabulary` strongest are kept;
2. the decay and size parameters of the extreme-value law that the best segment of a clean
   text follows; 3. a logistic curve from the resulting evidence to the share of toxic labels.

Scoring is one pass over whole texts: neutral tokens cost `drift`, all maximal segments come
from one linear scan, and their joint p-value is the evidence.

Defined cases: null and empty texts have no token and get the score of no evidence; repeated
rows get equal scores; several labels of a document count as toxic if one is; null labels are
left out; without labels of both kinds every score is the share of toxic labels (0 without
any); an empty table gives no rows; only doc_id, text and the labels are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm import words
from wardlight.llm.common import byte_view, char_starts, held_out, id_and_text, pieces, text_key, whole_row

#: Bound on the labelled documents that a model is fitted on.
MOST = 200_000
VOCABULARY, LEAST_Z, DRIFT, THRESHOLD = 20_000, 4.0, 0.05, 0.3
#: So many best segments of a text enter its joint p-value; evidence beyond CAP adds nothing.
JOINT, CAP = 20, 40.0


@dataclass(frozen=True)
class Model:
    keys: np.ndarray
    scores: np.ndarray
    drift: float = DRIFT
    decay: float = 1.0
    size: float = 1.0
    slope: float = 0.0
    base: float = 0.0

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * np.minimum(evidence, CAP) + self.base)))


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, sum) of a list of scores, in linear time.

    Candidates are kept with the sums before and after them. Each points to the nearest
    earlier one whose left sum is smaller, so no candidate is looked at twice in vain.
    """
    left: list[float] = []
    right: list[float] = []
    place: list[tuple[int, int]] = []
    smaller: list[int] = []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        low, first = before, i
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= low:
                j = smaller[j]
            if j < 0 or right[j] >= total:
                break
            low, first = left[j], place[j][0]
            del left[j:], right[j:], place[j:], smaller[j:]
        left.append(low)
        right.append(total)
        place.append((first, i))
        smaller.append(j)
    return [(a, b, r - x) for (a, b), x, r in zip(place, left, right, strict=True)]


def text_segments(at: np.ndarray, scores: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """Segments of a text whose scored tokens stand at the given places; the others cost drift."""
    gaps = np.diff(at, prepend=at[0] - 1) - 1
    mixed = np.empty(2 * len(at))
    mixed[0::2], mixed[1::2] = -drift * gaps, scores
    return [(int(at[a // 2]), int(at[b // 2]), s) for a, b, s in segments(mixed.tolist())]


def evidence(best: np.ndarray, n: int, decay: float, size: float) -> float:
    """-log of the joint p-value of the best segments of a text of n tokens.

    With normalised scores x = decay * S - log(size * n), the best one has the p-value
    1 - exp(-exp(-x)); the sum T of the r best has about exp(-T) T^(r-1) / (r! (r-1)!), paid
    for with a factor 2^r for trying every r.
    """
    if not len(best) or not n:
        return 0.0
    x = np.sort(decay * np.asarray(best, float) - math.log(max(size * n, 1e-300)))[::-1][:JOINT]
    found = -math.log(-math.expm1(-math.exp(-x[0]))) if x[0] < 30 else x[0]
    total = x[0]
    for r in range(2, len(x) + 1):
        total += x[r - 1]
        if x[r - 1] <= 0:
            break
        found = max(found, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2))
    return max(0.0, float(found))


def _tokens(column: pa.Array) -> tuple[np.ndarray, ...]:
    data, offsets = byte_view(column)
    data = words.LOWER[data] if len(data) else data
    starts, ends, firsts = words.spans(data, offsets, "letters")
    return data, offsets, starts, ends, firsts, words.hashes(data, starts, ends)


def sample(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, toxic of about `most` labelled documents at most, one for each text.

    Documents are taken by a hash of their id, so the same ones whenever the labels are.
    """
    truth = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = min(1.0, most / max(1, truth.count()))
    chosen = truth.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # The bound on the rows is the bound on what is broadcast.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).select("doc_id", "toxic")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each kind that hold a token, added up in the partition."""
    none = np.empty(0, np.int64)
    kept = (np.empty(0, np.uint64), none, none)
    waiting, size = [], 0

    def merged() -> tuple:
        keys, where = np.unique(np.concatenate([w[0] for w in waiting]), return_inverse=True)
        return keys, *(np.bincount(where, np.concatenate([w[i] for w in waiting]), len(keys)).astype(np.int64) for i in (1, 2))

    for batch in batches:
        for part in pieces(batch):
            *_, firsts, h = _tokens(part.column("text"))
            text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
            order = np.lexsort((h, text))
            h, text = h[order], text[order]
            once = np.ones(len(h), bool)
            once[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            toxic = part.column("toxic").to_numpy()[text[once]].astype(np.int64)
            waiting.append((h[once], toxic, 1 - toxic))
            size += len(toxic)
            if size > 2_000_000:
                waiting = [kept := merged()]
                size = len(kept[0])
    if waiting:
        kept = merged()
    for at in range(0, len(kept[0]), 50_000):
        yield pa.record_batch([pa.array(k[at : at + 50_000].view(np.int64)) for k in kept], names=["token", "toxic", "other"])


def _scan(model: Model, with_label: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = words.Lookup(model.keys, model.scores)
        for batch in batches:
            for part in pieces(batch):
                data, offsets, starts, ends, firsts, h = _tokens(part.column("text"))
                at, scores = lookup.find(h)
                cuts = np.searchsorted(at, firsts)
                found: list[list[tuple[int, int, float]]] = [[] for _ in range(part.num_rows)]
                for i in np.flatnonzero(np.diff(cuts)).tolist():
                    a, b = cuts[i], cuts[i + 1]
                    found[i] = text_segments(at[a:b], scores[a:b], model.drift)
                n = np.diff(firsts)
                if with_label:
                    best = [sorted((s for *_, s in x), reverse=True)[:JOINT] for x in found]
                    yield pa.record_batch([part.column("toxic"), pa.array(n), pa.array(best, pa.list_(pa.float64()))], names=["toxic", "n", "best"])
                    continue
                proof = np.array([evidence(np.array([s for *_, s in x]), int(k), model.decay, model.size) for x, k in zip(found, n, strict=True)])
                passages = []
                for i, x in enumerate(found):
                    if x:
                        chars = char_starts(data[offsets[i] : offsets[i + 1]])
                        x = [{"start": int(chars[starts[a] - offsets[i]]), "end": int(chars[ends[b] - offsets[i]]), "score": s} for a, b, s in x if evidence(np.array([s]), int(n[i]), model.decay, model.size) >= -math.log(0.05)]
                    passages.append(x)
                yield pa.record_batch([part.column("doc_id"), part.column("text_key"), pa.array(model.score(proof)), pa.array(proof), pa.array(passages, _PASSAGES)], names=["doc_id", "text_key", "score", "evidence", "passages"])

    return run


_PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _decay(scores: np.ndarray, shares: np.ndarray, drift: float) -> tuple[float, float]:
    """The positive root of sum(share * exp(root * score)) = 1, and a drift that makes the mean negative."""
    if not len(scores) or scores.max() <= 0:
        return 1.0, drift
    neutral = max(1e-9, 1 - shares.sum())
    drift = max(drift, 2 * float((shares * scores).sum()) / neutral)

    def excess(x: float) -> float:
        return float((shares * np.exp(np.minimum(x * scores, 600))).sum() + neutral * math.exp(-x * drift) - 1)

    low, high = 1e-6, 1.0
    while excess(high) < 0:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high, drift


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and base of a logistic curve by Newton steps, the slope held back by a small penalty."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    slope, base = 0.0, math.log(share / (1 - share))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + base, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([((y - p) * x).sum() - ridge * slope, (y - p).sum()])
        curve = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(curve, gradient)
        slope, base = slope + float(np.clip(step[0], -1, 1)), base + float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-6:
            break
    return max(0.0, slope), base


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST, vocabulary: int = VOCABULARY, least_z: float = LEAST_Z) -> Model:
    """A model of at most `vocabulary` tokens. What comes to the driver is bounded by `most` and `vocabulary`."""
    chosen = sample(docs, labels, most).persist()
    sizes = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    empty = Model(np.empty(0, np.uint64), np.empty(0))
    if len(sizes) < 2:
        chosen.unpersist()
        return Model(empty.keys, empty.scores, base=30.0 if 1 in sizes else -30.0)
    texts = id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    counts = texts.mapInArrow(_count, "token bigint, toxic bigint, other bigint").groupBy("token").agg(F.sum("toxic").alias("t"), F.sum("other").alias("c")).persist()
    sums = counts.agg(F.sum("t"), F.sum("c")).first()
    n_t, n_c = float(sums[0] or 0), float(sums[1] or 0)
    weight = max(1.0, min(n_t, n_c))
    prior = F.lit(weight) * (F.col("t") + F.col("c")) / F.lit(max(1.0, n_t + n_c))

    def log_odds(count: str, n: float):
        return F.log((F.col(count) + F.col("a")) / (F.lit(n + weight) - F.col(count) - F.col("a")))

    scored = (
        counts.withColumn("a", prior)
        .withColumn("delta", log_odds("t", n_t) - log_odds("c", n_c))
        .withColumn("z", F.col("delta") / F.sqrt(1 / (F.col("t") + F.col("a")) + 1 / (F.col("c") + F.col("a"))))
    )
    strong = scored.filter(F.abs("z") >= least_z).orderBy(F.abs("z").desc(), "token").limit(vocabulary).select("token", "delta", ((F.col("c") + F.col("a")) / F.lit(n_c + weight)).alias("share")).collect()
    counts.unpersist()
    keys = np.array([r["token"] for r in strong], np.int64).view(np.uint64)
    scores, shares = np.array([r["delta"] for r in strong], float), np.array([r["share"] for r in strong], float)
    decay, drift = _decay(scores, shares, DRIFT)
    model = Model(keys, scores, drift, decay)
    rows = texts.mapInArrow(_scan(model, True), "toxic int, n bigint, best array<double>").toPandas()
    chosen.unpersist()
    clean = rows[rows.toxic == 0]
    top = np.array([b[0] if len(b) else 0.0 for b in clean.best])
    size = len(clean) / max(1e-9, float((clean.n * np.exp(-decay * top)).sum()))
    x = np.array([min(CAP, evidence(b, int(n), decay, size)) for b, n in zip(rows.best, rows.n, strict=True)])
    slope, base = _logistic(x, rows.toxic.to_numpy(float))
    return Model(keys, scores, drift, decay, size, slope, base)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_key, score, evidence and the significant passages (code points) of every row."""
    schema = "doc_id bigint, text_key bigint, score double, evidence double, passages array<struct<start:int,end:int,score:double>>"
    return id_and_text(docs).withColumn("text_key", text_key()).mapInArrow(_scan(model, False), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose score is below the threshold, decided and filtered in one pass."""
    model = fit(docs, labels)
    rows = docs.select(whole_row(docs))
    return rows.mapInArrow(_keep(model, threshold), rows.schema).select("row.*")


def _keep(model: Model, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = words.Lookup(model.keys, model.scores)
        for batch in batches:
            for part in pieces(batch, batch.column("row").field("text")):
                *_, firsts, h = _tokens(part.column("row").field("text"))
                at, scores = lookup.find(h)
                cuts = np.searchsorted(at, firsts)
                proof = np.zeros(part.num_rows)
                for i in np.flatnonzero(np.diff(cuts)).tolist():
                    found = text_segments(at[cuts[i] : cuts[i + 1]], scores[cuts[i] : cuts[i + 1]], model.drift)
                    proof[i] = evidence(np.array([s for *_, s in found]), int(firsts[i + 1] - firsts[i]), model.decay, model.size)
                yield part.filter(pa.array(model.score(proof) < threshold))

    return run
