"""Language identification by string kernels.

The kernel of two texts counts the character n-grams (n = 1 to 3, the blended
spectrum) present in both, over the root of the product of the n-grams present in
either.  Some texts per language serve as Nyström landmarks; one-versus-rest
kernel ridge regression is fitted on the kernel between the training texts and
the landmarks.  A batch of texts is a matrix of presence flags over hashed
n-grams; its product with the landmarks' matrix gives the kernel, and one more
product the score of every language.

Letters are taken in lower case, everything between them counts as one blank.
Every n-gram of the whole text takes part.

The model is fitted on the driver from a bounded sample: per language, however
many there are, the ``TRAINING`` texts of at most ``SAMPLE_CHARS`` characters with
the smallest hash, or the shortest texts where a language has longer ones only.
With more than ``SHARING`` languages each has fewer texts and landmarks, one at
least, so that all of them together stay bounded.  What the workers get is 4 KB per
landmark and a number per language and landmark.

Rows: a null text, or one without letters, is ``und`` with score 0; languages
that are null or without a usable training text are not learnt; if none is, all
texts are ``und``; with one language every text with a letter is of that one; a
tie goes to the first language by code point; repeated rows are judged alike;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.tokens import text_runs

UNDETERMINED = "und"
LONGEST = 3
# Hashed n-grams; collisions only add a little noise to the kernel.
BITS = 15
# More languages than this share the texts and landmarks of so many.
SHARING = 100
TRAINING = 150
LANDMARKS = 24
SAMPLE_CHARS = 10_000
RIDGE = 0.1
# Texts, and landmarks, whose flags are held at once, 128 KB each.
ROWS = 64
MARKS = 256

# Rows with this remainder are held out.
FOLDS, HELD_OUT = 3, 1

_codes: list[np.ndarray] = []


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _letter_codes() -> np.ndarray:
    """Per code point of the basic plane: the lower-case letter, or 0."""
    if not _codes:
        table = np.zeros(1 << 16, dtype=np.uint32)
        for point in range(1 << 16):
            letter = chr(point)
            if letter.isalpha():
                lower = letter.lower()
                table[point] = ord(lower) if len(lower) == 1 else point
        _codes.append(table)
    return _codes[0]


def letters(text: str) -> np.ndarray:
    """Codes of a text's letters, with one 0 for whatever lies between words."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    table = _letter_codes()
    codes = table[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):
        codes[high] = [p if chr(p).isalpha() else 0 for p in points[high].tolist()]
    codes = np.concatenate(([0], codes, [0])).astype(np.uint32)
    blank = codes == 0
    return codes[~(blank & np.concatenate(([False], blank[:-1])))]


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the n-grams present, a row per text, and whether it has letters."""
    flags = np.zeros((len(texts), 1 << BITS), dtype=np.float32)
    some = np.zeros(len(texts), dtype=bool)
    for row, text in enumerate(texts):
        codes = letters(text) if text else np.zeros(0, np.uint32)
        if not codes.any():
            continue
        some[row] = True
        grams = np.zeros(len(codes), dtype=np.uint32)
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            grams = grams[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
            spread = grams * np.uint32(0x9E3779B1)
            spread ^= spread >> np.uint32(15)
            flags[row, (spread * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)] = 1
    return flags, some


def _unit(flags: np.ndarray) -> np.ndarray:
    """Divide by the root of the number of n-grams: products become kernels."""
    return flags / np.sqrt(np.maximum(flags.sum(axis=1, keepdims=True), 1))


class Landmarks:
    """Flags of the landmark texts, a bit each: 4 KB a text, also when sent to workers.

    They are spread out for a product, ``MARKS`` texts at a time; a worker keeps them
    spread out only if they are no more than that.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self._spread: np.ndarray | None = None

    def __getstate__(self):
        return {"bits": self.bits, "_spread": None}

    def _block(self, first: int) -> np.ndarray:
        if self._spread is not None:
            return self._spread
        block = _unit(np.unpackbits(self.bits[first : first + MARKS], axis=1).astype(np.float32))
        if len(self.bits) <= MARKS:
            self._spread = block
        return block

    def kernel(self, units: np.ndarray) -> np.ndarray:
        """The kernel between texts, as rows of length 1, and all landmarks."""
        found = np.empty((len(units), len(self.bits)), np.float32)
        for first in range(0, len(self.bits), MARKS):
            found[:, first : first + MARKS] = units @ self._block(first).T
        return found

    def among(self) -> np.ndarray:
        """The kernel between the landmarks."""
        return np.concatenate([self.kernel(self._block(f)) for f in range(0, len(self.bits), MARKS)])


@dataclass
class Model:
    languages: list[str]
    landmarks: Landmarks
    weights: np.ndarray


def _share(most: int, languages: int) -> int:
    """Texts or landmarks per language."""
    return max(1, min(most, most * SHARING // max(1, languages)))


def fit(texts: list[str], languages: list[str]) -> Model:
    """Kernel ridge regression on Nyström landmarks, one language against the rest."""
    names = sorted(set(languages), key=lambda name: name.encode())
    label = np.array([names.index(name) for name in languages], dtype=int)
    if not names:
        return Model([], Landmarks(np.zeros((0, (1 << BITS) // 8), np.uint8)), np.zeros((0, 0)))
    most = _share(LANDMARKS, len(names))
    chosen = np.concatenate([np.flatnonzero(label == k)[:most] for k in range(len(names))])
    # Flags of texts come and go; those of the landmarks are held as bits.
    bits = [
        np.packbits(presence([texts[i] for i in chosen[at : at + ROWS].tolist()])[0] > 0, axis=1)
        for at in range(0, len(chosen), ROWS)
    ]
    marks = Landmarks(np.concatenate(bits))
    parts = (_unit(presence(texts[i : i + ROWS])[0]) for i in range(0, len(texts), ROWS))
    kernel = np.concatenate([marks.kernel(p) for p in parts]).astype(float)
    own = marks.among().astype(float)
    # Every language weighs the same.
    weight = 1 / np.bincount(label, minlength=len(names))[label] / len(names)
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    left = (kernel * weight[:, None]).T @ kernel + RIDGE / len(texts) * own
    left += 1e-9 * np.trace(left) / len(left) * np.eye(len(left))
    return Model(names, marks, np.linalg.solve(left, (kernel * weight[:, None]).T @ target))


def judge(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of some texts."""
    flags, some = presence(texts)
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    value = model.landmarks.kernel(_unit(flags)) @ model.weights
    share = np.exp(4 * (value - value.max(axis=1, keepdims=True)))
    share /= share.sum(axis=1, keepdims=True)
    best = value.argmax(axis=1)
    names = [model.languages[k] if s else UNDETERMINED for k, s in zip(best.tolist(), some.tolist())]
    return names, np.where(some, share[np.arange(len(best)), best], 0.0)


def learning_sample(docs: DataFrame) -> tuple[list[str], list[str]]:
    """The bounded sample of texts with a known language.

    A language with most of the rows is cut to its first rows by hash before
    anything is brought together (a rank limit within a partition, then overall).
    """
    long = F.expr(f"length(text) > {SAMPLE_CHARS}")
    rows = (
        docs.select("doc_id", "text", "lang")
        .where("lang IS NOT NULL AND doc_id IS NOT NULL")
        .where(r"text RLIKE r'\p{L}'")
        .where(~held_out())
        .withColumn("_long", long)
    )
    most = _share(TRAINING, rows.select("lang").distinct().count())
    # Longer texts by length, behind all others.
    size = F.when(F.col("_long"), F.length("text")).otherwise(0)
    order = Window.partitionBy("lang").orderBy("_size", F.xxhash64("doc_id", F.lit(8)), "doc_id")
    first = (
        rows.select("doc_id", "lang", "_long", size.alias("_size"))
        .withColumn("_n", F.row_number().over(order))
        .where(f"_n <= {most}")
    )
    # Bounded: at most ``most`` rows per language.  Of longer texts, as many as have
    # the characters of so many others, the shortest one in any case.
    ids = (
        first.withColumn("_all", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_short", F.min("_long").over(Window.partitionBy("lang")) == F.lit(False))
        .where(f"NOT _long OR (NOT _short AND (_n = 1 OR _all <= {most * SAMPLE_CHARS}))")
        .select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("_size").alias("_chars"))
        .distinct()
    )
    found = (
        rows.withColumn("_size", size)
        .join(F.broadcast(ids), F.expr("doc_id = _id AND lang = _lang AND _size = _chars"))
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id", "lang")
        .collect()
    )
    return [r["text"] for r in found], [r["lang"] for r in found]


def learn(docs: DataFrame) -> Model:
    return fit(*learning_sample(docs))


def language(model: Model):
    """A function of a text column: its language and score."""

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names: list[str] = []
            scores = []
            for run in text_runs(texts):
                part = texts[run].to_pylist()
                for at in range(0, len(part), ROWS):
                    name, score = judge(part[at : at + ROWS], model)
                    names += name
                    scores.append(score)
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=["lang_pred", "score"],
            )

    judged.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(judged, "STRUCT<lang_pred: STRING, score: DOUBLE>")


def identify(docs: DataFrame) -> DataFrame:
    """Language and score of every document."""
    rated = docs.select("doc_id", language(learn(docs))("text").alias("_r"))
    return rated.select(
        "doc_id", held_out().alias("held_out"),
        F.col("_r.lang_pred").alias("lang_pred"), F.col("_r.score").alias("score"),
    )
