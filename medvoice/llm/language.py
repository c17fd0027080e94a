"""Language identification by a string kernel, Nyström landmarks and ridge regression.

The kernel is the blended spectrum kernel with presence features: two texts are as alike
as the number of runs of one to ``longest`` bytes that both hold, over the geometric mean
of how many each holds. Runs are told apart by a hash of ``BITS`` bits, so a text is a row
of 2**BITS bits whatever its length, and a kernel value is a product of two such rows.

Learning. A bounded sample of the labelled rows, at most ``sample`` in all and as many of
each language, is taken by least hash. ``landmarks`` texts of it stand for the kernel's
space (Nyström): a text is described by its kernel values with them, turned by the inverse
root of the landmarks' own kernel matrix. Kernel ridge regression in that space gives one
function per language against the rest. Only the kernel rows of the sample reach the
driver: 4 bytes for each row and landmark.

Scoring. A batch of texts is a 0/1 matrix; its product with the landmarks' rows and the
product of that with the regression's coefficients are one product with a matrix of 2**BITS
rows and a column a language, which is made once and sent to the tasks.

The prediction is the language of the largest function value, its score that value moved
from [-1, 1] to [0, 1]. A text that is null or has no letter is ``und`` with score 0, and
so is any text if nothing was learnt. Whole texts are read, long ones in pieces. Rows
without a language or an id are not learnt from; repeated rows count once in the sample.
Ties between languages go to the first by name. Other columns are kept, whatever their
names; an added name that is taken gets an underscore at its end.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medvoice.llm import arrays
from medvoice.llm.frames import forget, stored, unused, with_fields

UNKNOWN = "und"
#: Rows learnt from, texts that stand for the kernel's space, ridge, longest run of bytes.
SAMPLE, LANDMARKS, RIDGE, LONGEST = 8_000, 256, 1e-3, 4
#: Languages that a model may have; the matrix sent to the tasks has a column for each.
LANGUAGES = 400
BITS = 16
SIZE = 1 << BITS
#: Texts that one matrix product scores.
ROWS = 64


def is_held_out(doc_id: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether the remainder of the id's checksum is ``fold``; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def runs_of(text: str, longest: int = LONGEST) -> np.ndarray:
    """Which of the hashed runs of bytes the lower-cased text holds."""
    held = np.zeros(SIZE, dtype=bool)
    data = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    for at in range(0, len(data), arrays.PIECE):
        piece = data[at : at + arrays.PIECE + longest - 1].astype(np.uint32)
        run = piece
        for n in range(1, longest + 1):
            if n > 1:
                run = (run[:-1] << np.uint32(8)) ^ (run[:-1] >> np.uint32(24)) ^ piece[n - 1 :]
            if len(run):
                # Multiplicative hashing; the length takes part, so runs of unlike lengths differ.
                held[((run ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)] = True
    return held


@dataclass
class Classifier:
    """Languages by name, and a column for each: what a run adds to its function value."""

    languages: list[str]
    weights: np.ndarray
    longest: int

    def values(self, held: np.ndarray) -> np.ndarray:
        """Function values of texts given as rows of a 0/1 matrix."""
        sums = held @ self.weights
        # The last column counts runs: the norm that the kernel divides by.
        return sums[:, :-1] / np.sqrt(np.maximum(sums[:, -1:], 1))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        spoken = [i for i, t in enumerate(texts) if self.languages and has_letter(t)]
        matrix = np.empty((min(ROWS, len(spoken)), SIZE), dtype=np.float32)
        for a in range(0, len(spoken), ROWS):
            rows = spoken[a : a + ROWS]
            for k, i in enumerate(rows):
                matrix[k] = runs_of(texts[i], self.longest)
            found = self.values(matrix[: len(rows)])
            best = found.argmax(axis=1)
            for k, i in enumerate(rows):
                names[i] = self.languages[best[k]]
                scores[i] = float(np.clip((found[k, best[k]] + 1) / 2, 0, 1))
        return names, scores


def normalized(held: np.ndarray) -> np.ndarray:
    """Rows of a 0/1 matrix over the root of how many ones they have."""
    return held / np.sqrt(np.maximum(held.sum(axis=1, keepdims=True), 1))


def regression(rows: np.ndarray, own: np.ndarray, names: np.ndarray, ridge: float) -> tuple[list[str], np.ndarray]:
    """Languages, and a coefficient for each landmark and language.

    ``rows`` are kernel values of the sample with the landmarks, ``own`` those between
    landmarks. In the Nyström space K(x, L) K(L, L)^(-1/2) the ridge regression has a
    plain solution; its coefficients are turned back to landmarks.
    """
    value, vector = np.linalg.eigh(own)
    good = value > 1e-6 * max(float(value.max()), 1e-12)
    turn = vector[:, good] / np.sqrt(value[good])
    space = rows @ turn
    languages = sorted(set(names))
    goal = np.where(names[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    inner = space.T @ space + ridge * len(space) * np.eye(space.shape[1])
    return languages, turn @ np.linalg.solve(inner, space.T @ goal)


def labelled_sample(docs: DataFrame, text: str, doc_id: str, lang: str, sample: int) -> DataFrame:
    """``(text, lang, rank)`` of about ``sample`` rows in all and equal parts of each language, by least hash.

    A language's rows are counted first; a row is taken if its hash is below the share
    that its language may have, so no task orders or holds a language's rows.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & ~is_held_out(doc_id))
    usable = usable.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(doc_id).alias("id"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages: the model has a column for each")
    each = max(1, sample // max(1, len(counts)))
    place = F.xxhash64("id", "lang") / F.lit(2.0**64) + 0.5
    taken = F.lit(False)
    for name, n in counts.items():
        taken = taken | ((F.col("lang") == name) & (F.col("rank") < each / n))
    rows = usable.withColumn("rank", place).where(taken & F.col("text").isNotNull())
    return rows.groupBy("rank", "lang").agg(F.min("text").alias("text"))


def fit(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    lang: str = "lang",
    sample: int = SAMPLE,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
    longest: int = LONGEST,
) -> Classifier:
    """Learn from a bounded sample of the rows that have a language and are not held out."""
    spark = docs.sparkSession
    rows = stored(labelled_sample(docs, text, doc_id, lang, sample), "languages")

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in arrays.slices(batches, "text"):
            bits = [np.packbits(runs_of(t.decode(), longest)).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], names=["lang", "bits"])

    # Landmarks by turns from the languages: the least ranks are the same for any layout.
    named = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    chosen = []
    for name in named:
        some = rows.where(F.col("lang") == name).orderBy("rank", F.xxhash64("text")).limit(max(1, landmarks // len(named)))
        chosen += some.select("lang", "text").mapInArrow(packed, "lang string, bits binary").collect()
    if not chosen:
        forget(rows)
        return Classifier([], np.zeros((SIZE, 1), dtype=np.float32), longest)
    marks = np.unpackbits(np.frombuffer(b"".join(r["bits"] for r in chosen), dtype=np.uint8)).reshape(-1, SIZE)
    marks = normalized(np.unique(marks, axis=0).astype(np.float32))
    sent = spark.sparkContext.broadcast(np.ascontiguousarray(marks.T))

    def described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in arrays.slices(batches, "text"):
            for a in range(0, len(texts), ROWS):
                held = np.stack([runs_of(t.decode(), longest) for t in texts[a : a + ROWS]]).astype(np.float32)
                values = (normalized(held) @ sent.value).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(values)), pa.array([v.tobytes() for v in values], pa.binary())],
                    names=["lang", "values"],
                )

    seen = rows.select("lang", "text").mapInArrow(described, "lang string, values binary").toArrow()
    forget(rows)
    values = np.frombuffer(b"".join(seen["values"].to_pylist()), dtype=np.float32).reshape(-1, len(marks))
    names = np.array(seen["lang"].to_pylist())
    # The order of the rows must not matter to the last bit of the sums.
    order = np.lexsort((*values.T[:8], names))
    languages, alpha = regression(
        values[order].astype(np.float64), (marks @ marks.T).astype(np.float64), names[order], ridge
    )
    weights = np.concatenate((marks.T.astype(np.float64) @ alpha, np.ones((SIZE, 1))), axis=1)
    return Classifier(languages, weights.astype(np.float32), longest)


def predict(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``score``."""
    added = [unused(docs, c) for c in ("lang_pred", "score")]
    names = [*docs.columns, *added]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in arrays.slices(batches, text):
            found, scores = sent.value.predict([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=names
            )

    return docs.mapInArrow(apply, with_fields(docs.schema, (added[0], T.StringType()), (added[1], T.DoubleType())))
