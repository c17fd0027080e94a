"""Fill-in-middle transformation: texts cut at token boundaries and put in another order.

A text's boundaries are the ends of its tokens, counted in code points. Where boundary
number ``rank`` lies is told by a learned index: piecewise linear segments, fitted so that
no boundary is further than ``error`` from its prediction, and the residual of every
boundary in one byte. A cut is looked up by predicting it and adding its residual, which
is exact; residuals take an eighth of the memory of the offsets.

Cuts and forms come from a checksum of the seed and the document's id, so they do not
depend on how rows are dealt out. Every row is handled by itself: no shuffle, and memory
for one text at a time. A null text is empty; an empty text is plain. A missing id counts
as an empty one. Repeated rows give repeated results. Other columns are kept, whatever
their names; an added name that is taken gets an underscore at its end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from medvoice.llm import arrays
from medvoice.llm.frames import unused, with_fields

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Of a hundred documents so many are transformed, and of a hundred of those so many suffix first.
RATE, SPM_RATE = 90, 20
#: Largest residual, which is kept in a signed byte.
ERROR = 120
# Boundaries fitted at once, and bytes of text handed on at once.
STEP = 256
SLICE = 8 << 20


def boundaries(text: str) -> np.ndarray:
    """Offsets of all token ends, 0 first: a token is a run of A-Z and a-z, or one other code point."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    letter = ((points | 32) >= 97) & ((points | 32) <= 122)
    end = np.ones(len(points), dtype=bool)
    end[:-1] = ~(letter[:-1] & letter[1:])
    return np.concatenate(([0], np.flatnonzero(end) + 1))


@dataclass
class RankIndex:
    """Segments (first rank, offset there, offsets a rank) and a residual per boundary."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predicted(self, rank: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.first, rank, side="right") - 1
        return self.base[s] + np.rint(self.slope[s] * (rank - self.first[s])).astype(np.int64)

    def offset(self, rank: np.ndarray | int) -> np.ndarray:
        """Exact offsets of boundaries: predicted, then corrected."""
        rank = np.asarray(rank, dtype=np.int64)
        return self.predicted(rank) + self.residual[rank]


def fit(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """Segments as long as a line through their first boundary stays within ``error`` of all others.

    The slopes allowed narrow from boundary to boundary; a segment ends before the one
    that leaves none. Running extremes give that place for many boundaries at once.
    """
    if not 1 <= error <= 126:
        raise ValueError("residuals are kept in a byte: an error of 1 to 126")
    first, slope = [], []
    at, n = 0, len(offsets)
    while at < n:
        low, high, end, step = 0.0, np.inf, at + 1, STEP
        while end < n:
            run = np.arange(end, min(n, end + step), dtype=np.float64) - at
            rise = (offsets[end : end + len(run)] - offsets[at]).astype(np.float64)
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            bad = np.flatnonzero(lows > highs)
            good = int(bad[0]) if len(bad) else len(run)
            if good:
                low, high = lows[good - 1], highs[good - 1]
            end += good
            step *= 2
            if len(bad):
                break
        first.append(at)
        slope.append((low + high) / 2 if np.isfinite(high) else 0.0)
        at = end
    start = np.array(first, dtype=np.int64)
    index = RankIndex(start, offsets[start], np.array(slope), np.zeros(0, dtype=np.int8))
    residual = offsets - index.predicted(np.arange(n))
    if len(residual) and int(np.abs(residual).max()) > error + 1:
        raise AssertionError("a residual beyond the error bound")
    index.residual = residual.astype(np.int8)
    return index


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def form_of(text: str, h3: int, h4: int, rate: int = RATE, spm_rate: int = SPM_RATE) -> str:
    """``plain``, ``psm`` or ``spm``. A text that holds a marker could not be told apart again."""
    if not text or h3 % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return "plain"
    return "spm" if h4 % 100 < spm_rate else "psm"


def arranged(text: str, form: str, low: int, high: int) -> str:
    """The text cut at two offsets, in the form's order."""
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    if form == "spm":
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return text


def restored(output: str, form: str) -> str:
    """The text that :func:`arranged` was given, from its result and form alone."""
    if form == "plain":
        return output
    start, then = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(start):
        raise ValueError(f"no {start} at the start")
    left, rest = output[len(start) :].split(then, 1)
    right, middle = rest.split(MIDDLE, 1)
    return left + middle + right if form == "psm" else right + middle + left


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    error: int = ERROR,
) -> DataFrame:
    """The documents with ``n`` tokens, ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``."""
    added = [unused(docs, c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")]
    number = docs.columns.index(doc_id)
    names = [*docs.columns, *added]
    schema = with_fields(docs.schema, *zip(added, (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())))

    def one(own: str, key: int | None) -> tuple[int, str, int | None, int | None, str]:
        h1, h2, h3, h4 = draws(key, seed)
        ends = boundaries(own)
        n, form = len(ends) - 1, form_of(own, h3, h4, rate, spm_rate)
        if form == "plain":
            return n, form, None, None, own
        cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
        low, high = fit(ends, error).offset(np.array(cuts)).tolist()
        return n, form, low, high - low, arranged(own, form, low, high)

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        for batch, texts in arrays.slices(batches, text, most=SLICE):
            keys = batch.column(number).to_pylist()
            made = zip(*(one(own.decode(), key) for own, key in zip(texts, keys)))
            new = [pa.array(c, t) for c, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return docs.mapInArrow(apply, schema)


def with_restored(made: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """The table with ``restored``: the text rebuilt from each output and its form."""
    name = unused(made, "restored")
    names = [*made.columns, name]

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, outputs in arrays.slices(batches, output, most=SLICE):
            forms = batch.column(batch.schema.get_field_index(form)).to_pylist()
            texts = [restored(o.decode(), f) for o, f in zip(outputs, forms)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return made.mapInArrow(apply, with_fields(made.schema, (name, T.StringType())))
