"""Toxic spans by a linear-chain conditional random field, and document scores.

The labels are per document, so tokens are labelled first: in a toxic training
document those with a feature (the word or one of its beginnings) that sets toxic
documents apart, by a likelihood-ratio test and a least lift; all others are
clean.  The field is then fitted to these token labels by gradient steps on its
likelihood, with forward-backward sums.  Scoring runs forward-backward over every
whole text; tokens whose marginal reaches one half form the offending spans, and
the largest marginal and the sum of marginals make the document's score through a
small logistic calibration.

The model is fitted on the driver from a bounded sample: the ``SAMPLE_DOCS`` texts
per label with the smallest hash, of at most ``SAMPLE_CHARS`` characters each; of a
label that longer texts alone have, the shortest ones up to ``LONG_CHARS`` in all.
Scoring has no such limits; a chain is cut into rows whose transfer matrices are
multiplied, so one huge text costs no more than many small ones.

Rows: a null text, or one without words, gets the score of a text without any
sign of toxicity; labels of null doc_ids, null labels and labels without a text
are not learnt from; where a doc_id has several labels the largest counts; without
toxic or without clean training texts every score is the same, 0 or 1; repeated
rows are scored alike; other columns are kept by ``clean_documents``; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.stash import stash
from cohortry.llm.tokens import release_memory, text_runs

SAMPLE_DOCS = 1200
SAMPLE_CHARS = 20_000
# Characters, in all, of the sample of a label that only longer texts have.
LONG_CHARS = 2_000_000
# Most features of a model, those with the clearest association.
FEATURES = 8_000
HASH_BITS = 22
# Tokens of one slice of the training texts.
SLICE_TOKENS = 100_000
PREFIXES = (3, 4, 5, 6, 7, 8)
LEAST_LIFT = 20.0
STEPS = 35
RATE = 0.25
RIDGE = 1e-3
# Bytes of text that a worker assesses at once.
RUN_BYTES = 1_000_000
# Words remembered per worker.
CACHE_WORDS = 150_000

# Fixed value: the learning rows are those where this remainder is not 0.
FOLDS = 5

_WORD = re.compile(r"[^\W_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def word_features(word: str) -> list[str]:
    word = word.lower()
    return [word, *[f"{word[:k]}-" for k in PREFIXES if k < len(word)]]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    # Log potentials: start in (clean, toxic); from (row) to (column).
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    # Logistic calibration: constant, log odds of the largest marginal, log of the sum.
    calibration: tuple[float, float, float] = (0.0, 0.0, 0.0)
    constant: float | None = None


def marginals(scores: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray):
    """Forward and backward messages (scaled), per token, of many chains in a row.

    ``scores`` are the log potentials of being toxic, ``first`` marks the first
    token of each chain.  Rows of a grid are worked on side by side: their 2 x 2
    transfer matrices give the messages at their ends, which start the second pass.
    """
    n = len(scores)
    width = max(1, int(math.sqrt(n)))
    height = -(-n // width)
    pad = height * width - n
    steps = np.empty((n, 2, 2))
    steps[:] = np.exp(moves)
    steps[first] = np.exp(start)
    steps[:, :, 1] *= np.exp(np.clip(scores, -40, 40))[:, None]
    steps = np.concatenate((steps, np.broadcast_to(np.eye(2), (pad, 2, 2))))
    grid = steps.reshape(height, width, 2, 2)

    def scaled(m: np.ndarray) -> np.ndarray:
        return m / m.sum(axis=tuple(range(1, m.ndim)), keepdims=True)

    def apply(vectors: np.ndarray, matrices: np.ndarray) -> np.ndarray:
        return scaled(
            vectors[:, :1] * matrices[:, 0, :] + vectors[:, 1:] * matrices[:, 1, :]
        )

    whole = grid[:, 0]
    for t in range(1, width):
        whole = scaled(whole @ grid[:, t])
    ahead, behind = np.empty((height, 2)), np.empty((height, 2))
    now = np.array([[1.0, 1.0]])
    for row in range(height):
        ahead[row] = now
        now = apply(now, whole[row : row + 1])
    now = np.array([[1.0, 1.0]])
    for row in range(height - 1, -1, -1):
        behind[row] = now
        now = apply(now, whole[row : row + 1].transpose(0, 2, 1))

    forward, backward = np.empty((height, width, 2)), np.empty((height, width, 2))
    now = ahead
    for t in range(width):
        now = forward[:, t] = apply(now, grid[:, t])
    now = behind
    for t in range(width - 1, -1, -1):
        backward[:, t] = now
        now = apply(now, grid[:, t].transpose(0, 2, 1))
    return forward.reshape(-1, 2)[:n], backward.reshape(-1, 2)[:n], steps[:n]


def toxic_marginals(scores: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """Probability of being toxic, per token."""
    if not len(scores):
        return np.zeros(0)
    forward, backward, _ = marginals(scores, first, model.start, model.moves)
    both = forward * backward
    return both[:, 1] / both.sum(axis=1)


def _association(a: np.ndarray, b: np.ndarray, n1: int, n0: int):
    """Likelihood ratio and lift of features that a toxic and b clean documents have."""
    total = n1 + n0
    ratio = np.zeros(len(a))
    for seen, size in ((a, n1), (b, n0)):
        for found, share in ((seen, (a + b) / total), (size - seen, 1 - (a + b) / total)):
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio += np.where(found > 0, 2 * found * np.log(found / (size * share)), 0)
    lift = ((a + 0.5) / (n1 + 1)) / ((b + 0.5) / (n0 + 1))
    return ratio, lift


def _document_features(text: str) -> set[str]:
    return {f for w in {w.lower() for w in _WORD.findall(text)} for f in word_features(w)}


def _telling_features(texts: list[str], y: np.ndarray):
    """The ``FEATURES`` features of clearest association: names, ratio, lift, toxic documents.

    Documents are first counted per hash of the feature; only features whose hash
    could matter are then counted by name, so the memory stays small.
    """
    n1, n0 = int(y.sum()), int((1 - y).sum())
    slots = np.zeros((2, 1 << HASH_BITS), dtype=np.int32)
    mask = (1 << HASH_BITS) - 1
    distinct = 0
    for text, label in zip(texts, y.tolist()):
        names = _document_features(text)
        distinct += len(names)
        hashes = np.fromiter((zlib.crc32(f.encode()) & mask for f in names), np.int64, len(names))
        np.add.at(slots[label], hashes, 1)
    known = np.flatnonzero(slots.sum(axis=0) > 1)
    ratio, _ = _association(slots[1][known].astype(float), slots[0][known].astype(float), n1, n0)
    wanted = np.zeros(1 << HASH_BITS, dtype=bool)
    wanted[known[np.argsort(-ratio, kind="stable")[: 2 * FEATURES]]] = True
    counts = (Counter(), Counter())
    for text, label in zip(texts, y.tolist()):
        counts[label].update(
            f for f in _document_features(text) if wanted[zlib.crc32(f.encode()) & mask]
        )
    names = sorted(set(counts[0]) | set(counts[1]))
    a, b = (np.array([counts[k][f] for f in names], dtype=float) for k in (1, 0))
    ratio, lift = _association(a, b, n1, n0)
    order = np.argsort(-ratio, kind="stable")[:FEATURES]
    return [names[i] for i in order], ratio[order], lift[order], a[order], distinct


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    x = np.column_stack((np.ones(len(x)), x))
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        beta += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return beta


def _summary(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per document: log odds of the largest marginal and log of the sum."""
    largest, total = np.full(n, 1e-9), np.full(n, 1e-9)
    np.maximum.at(largest, owner, p)
    np.add.at(total, owner, p)
    largest = np.clip(largest, 1e-9, 1 - 1e-9)
    return np.column_stack((np.log(largest / (1 - largest)), np.log(total)))


def fit(texts: list[str], toxic: list[int], share: float) -> Model:
    """A model from labelled texts; ``share`` is the share of toxic documents."""
    y = np.asarray(toxic)
    n1, n0 = int(y.sum()), int((1 - y).sum())
    if not n1 or not n0:
        return Model(constant=1.0 if n1 else 0.0)
    names, ratio, lift, support, distinct = _telling_features(texts, y)
    number = {name: k for k, name in enumerate(names)}
    sure = max(6.6, min(2 * math.log(distinct + 1), 0.5 * ratio.max(initial=0)))
    signs = (ratio >= sure) & (lift >= min(LEAST_LIFT, 0.5 * lift[support > 1].max(initial=2)))
    marks = {names[i] for i in np.flatnonzero(signs).tolist()}

    # Words without a telling feature are all alike: number 0.
    vocabulary: dict[str, int] = {"": 0}
    features: list[list[int]] = [[]]
    plain: set[str] = set()
    chains, sizes = [], []
    for text in texts:
        words = [w.lower() for w in _WORD.findall(text)]
        for word in set(words) - plain:
            if word not in vocabulary:
                found = [number[f] for f in word_features(word) if f in number]
                if found:
                    vocabulary[word] = len(features)
                    features.append(found)
                else:
                    plain.add(word)
        if len(plain) > CACHE_WORDS:
            plain.clear()
        chains.append(np.fromiter((vocabulary.get(w, 0) for w in words), np.int32, len(words)))
        sizes.append(len(words))
    sizes = np.array(sizes)
    marked = np.array([any(names[f] in marks for f in fs) for fs in features])
    pairs = [(w, f) for w, fs in enumerate(features) for f in fs]
    of_word, of_feature = np.array(pairs, dtype=int).reshape(-1, 2).T

    # Slices of whole documents, so that a step needs little memory at once.
    part = np.cumsum(sizes) // SLICE_TOKENS
    slices = []
    for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(part)) + 1):
        if not sizes[rows].sum():
            continue
        word = np.concatenate([chains[i] for i in rows])
        first = np.zeros(len(word), dtype=bool)
        first[(np.cumsum(sizes[rows]) - sizes[rows])[sizes[rows] > 0]] = True
        owner = np.repeat(rows, sizes[rows])
        slices.append((word, first, owner, marked[word] & (y[owner] == 1)))

    k = len(names)
    theta = np.zeros(k + 6)  # features, bias, start of toxic, four moves (clean to clean is 0)
    theta[k], theta[k + 1] = -3.0, -1.0
    slow, square = np.zeros_like(theta), np.zeros_like(theta)

    def scores() -> np.ndarray:
        return theta[k] + np.bincount(of_word, weights=theta[of_feature], minlength=len(features))

    for step in range(1, STEPS + 1):
        per_word = scores()
        start, moves = np.array([0.0, theta[k + 1]]), theta[k + 2 : k + 6].reshape(2, 2)
        slope, short = np.zeros_like(theta), np.zeros(len(features))
        for word, first, _, label in slices:
            forward, backward, matrices = marginals(per_word[word], first, start, moves)
            both = forward * backward
            p = both[:, 1] / both.sum(axis=1)
            inner = np.flatnonzero(~first)
            joint = forward[inner - 1][:, :, None] * matrices[inner] * backward[inner][:, None, :]
            joint = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            seen = np.bincount(2 * label[inner - 1] + label[inner], minlength=4).reshape(2, 2)
            short += np.bincount(word, weights=label - p, minlength=len(features))
            slope[k + 1] += (label[first] - p[first]).sum()
            slope[k + 2 : k + 6] += (seen - joint).ravel()
        slope[:k] = np.bincount(of_feature, weights=short[of_word], minlength=k)
        slope[k] = short.sum()
        slope[k + 2] = 0.0
        slope = slope / len(texts) - RIDGE * theta
        slow = 0.9 * slow + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta += RATE * (slow / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    model = Model(
        weights={n: float(theta[i]) for n, i in number.items() if abs(theta[i]) > 1e-4},
        bias=float(theta[k]),
        start=np.array([0.0, theta[k + 1]]),
        moves=theta[k + 2 : k + 6].reshape(2, 2).copy(),
    )
    per_word = scores()
    found = _summary(np.zeros(0), np.zeros(0, int), len(texts))
    for word, first, owner, _ in slices:
        rows = np.unique(owner)
        p = toxic_marginals(per_word[word], first, model)
        found[rows] = _summary(p, np.searchsorted(rows, owner), len(rows))
    weight = np.where(y == 1, share / n1, (1 - share) / n0) * len(y)
    model.calibration = tuple(_logistic(found, y, weight).tolist())
    return model


def word_score(model: Model, word: str) -> float:
    get = model.weights.get
    return model.bias + sum([get(f, 0.0) for f in word_features(word)])


class _Scores(dict):
    """Scores of words, worked out when first met."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        score = self[word] = word_score(self.model, word)
        return score


def _chosen(labelled: DataFrame, toxic: int, short: int) -> DataFrame:
    """The documents of one label to learn from."""
    own = labelled.where(F.col("_toxic") == toxic).select("doc_id", "_toxic", "_chars")
    if short:
        order = [F.xxhash64("doc_id", F.lit(5)), F.col("doc_id")]
        return own.where(f"_chars <= {SAMPLE_CHARS}").orderBy(*order).limit(SAMPLE_DOCS)
    # Long texts only: the shortest of them, as many as fit, but one at least.
    rows = own.orderBy("_chars", "doc_id").limit(SAMPLE_DOCS).collect()
    total, ids = 0, []
    for row in rows:
        total += row["_chars"]
        if ids and total > LONG_CHARS:
            break
        ids.append(row["doc_id"])
    return own.where(F.col("doc_id").isin(ids))


def learning_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int], float]:
    """The bounded sample of labelled texts, and the share of toxic documents."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
        .where(~held_out())
    )
    sized = docs.select("doc_id", F.length("text").alias("_chars")).where("_chars >= 1")
    labelled = stash(
        sized.join(known, "doc_id").groupBy("doc_id", "_toxic").agg(F.min("_chars").alias("_chars")),
        "labelled",
    )
    counts = {
        r["_toxic"]: (r["texts"], r["short"])
        for r in labelled.groupBy("_toxic")
        .agg(F.count(F.lit(1)).alias("texts"), F.count_if(F.col("_chars") <= SAMPLE_CHARS).alias("short"))
        .collect()
    }
    if not counts:
        return [], [], 0.0
    chosen = reduce(
        DataFrame.union, [_chosen(labelled, toxic, short) for toxic, (_, short) in sorted(counts.items())]
    )
    # Bounded: twice SAMPLE_DOCS ids.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .where(F.length("text") == F.col("_chars"))
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("_toxic").alias("toxic"))
        .orderBy("doc_id")
        .collect()
    )
    share = counts.get(1, (0, 0))[0] / sum(texts for texts, _ in counts.values())
    return [r["text"] for r in rows], [r["toxic"] for r in rows], share


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(*learning_sample(docs, labels))


_RESULT = "STRUCT<score: DOUBLE, spans: ARRAY<STRUCT<start: INT, end: INT, toxicity: DOUBLE>>>"
_SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("toxicity", pa.float64())])
)


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of offending tokens, by character offsets, with their largest marginal."""
    found: list[dict] = []
    last = None
    places = [m.span() for m in _WORD.finditer(text)]
    for t in np.flatnonzero(p >= 0.5).tolist():
        start, end = places[t]
        if last == t - 1 and found:
            found[-1]["end"] = end
            found[-1]["toxicity"] = max(found[-1]["toxicity"], float(p[t]))
        else:
            found.append({"start": start, "end": end, "toxicity": float(p[t])})
        last = t
    return found


def assess(texts: list[str | None], scores: _Scores) -> tuple[np.ndarray, list[list[dict]]]:
    """Document scores and offending spans of some texts."""
    model = scores.model
    if model.constant is not None:
        return np.full(len(texts), model.constant), [[] for _ in texts]
    if len(scores) > CACHE_WORDS:
        scores.clear()
    words = [_WORD.findall(t or "") for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    get = scores.__getitem__
    flat = np.fromiter((s for w in words for s in map(get, w)), float, int(sizes.sum()))
    ends = np.cumsum(sizes)
    first = np.zeros(len(flat), dtype=bool)
    first[(ends - sizes)[sizes > 0]] = True
    p = toxic_marginals(flat, first, model)
    found = _summary(p, np.repeat(np.arange(len(texts)), sizes), len(texts))
    a, b, c = model.calibration
    value = 1 / (1 + np.exp(-np.clip(a + found @ np.array([b, c]), -30, 30)))
    odd = found[:, 0] >= 0
    spans = [
        _spans(texts[i], p[ends[i] - sizes[i] : ends[i]]) if odd[i] else []
        for i in range(len(texts))
    ]
    return value, spans


def toxicity(model: Model):
    """A function of a text column: its score and offending spans."""

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Scores(model)
        for texts in batches:
            values, spans = [], []
            for run in text_runs(texts, RUN_BYTES):
                value, where = assess(texts[run].to_pylist(), known)
                values.append(value)
                spans += where
            score = np.concatenate(values) if values else np.zeros(0)
            yield pa.StructArray.from_arrays(
                [pa.array(score, pa.float64()), pa.array(spans, _SPANS)], names=["score", "spans"]
            )
        known.clear()
        release_memory()

    scored.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scored, _RESULT)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score, verdict and offending spans of every document."""
    rated = docs.select("doc_id", toxicity(learn(docs, labels))("text").alias("_r"))
    return rated.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_r.score").alias("score"),
        F.expr("int(_r.score >= 0.5)").alias("predicted"),
        F.col("_r.spans").alias("spans"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    rated = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("_doc"),
        toxicity(learn(docs, labels))("text").alias("_r"),
    )
    return rated.where("_r.score < 0.5").select("_doc.*")
