"""Substring dedup: words inside any run of ``width`` words that occurs elsewhere too.

Pass 1, a count-min sketch. Every window of ``width`` words chooses one of the shorter
word runs inside it (the one of least hash), so equal windows choose equal runs at equal
places. The sketch counts the chosen places, a tenth of the windows; the count of a
window's run is an overestimate of the count of the window, and the sketch's estimate
is an overestimate of that, so no repeated window is lost. Partitions build their parts
and the parts are merged by range.

Pass 2, exact grouping of what is estimated repeated. Neighbouring windows of one chosen
run form a block, identified by 128 bits: two hashes of 64, each made of a hash of its words
that is independent of the other's. Equal blocks are counted first,
which reduces copies of any number to one row; then the windows of the distinct blocks
are counted, a block's count being the weight of its windows.

Texts are taken as they are; null has no words. Rows are told apart, so two equal rows
repeat each other. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medvoice.llm import arrays
from medvoice.llm.frames import id_of, stored, unused, with_fields
from medvoice.llm.sketch import Sketch, build

WIDTH = 35
BITS, DEPTH = 27, 3


class _Windows:
    """Windows of some texts, their chosen runs, and the blocks they form."""

    def __init__(self, texts: list[bytes], width: int):
        run = (width + 1) // 2
        found = arrays.words(texts, bases=arrays.BYTE_BASES)
        self.hash, self.other, self.width = found.hash, found.other, width
        self.offsets = found.of_doc(len(texts))
        self.start, _ = self._starts(width)
        where, self.runs = arrays.windows(self.hash, self.offsets, run)
        counts = np.maximum(np.diff(self.offsets) - run + 1, 0)
        run_offsets = np.concatenate(([0], np.cumsum(counts)))
        chosen = arrays.anchors(self.runs, run_offsets, width - run + 1)
        self.doc = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.chosen = chosen[run_offsets[self.doc] + self.start - self.offsets[self.doc]] if len(self.start) else self.start

    def _starts(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        return arrays.windows(self.hash, self.offsets, width)

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of each block."""
        first = np.flatnonzero(np.concatenate(([True], self.chosen[1:] != self.chosen[:-1]))) if len(self.chosen) else self.chosen
        return first, np.diff(np.concatenate((first, [len(self.chosen)])))

    def hashed(self, start: np.ndarray, length: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        both = zip((self.hash, self.other), arrays.WORD_BASES)
        return tuple(arrays.rolling(h, b, start, start + length) for h, b in both)


def _occurrences(
    batches: Iterable[pa.RecordBatch], width: int, sketch: Sketch, with_windows: bool
) -> Iterator[pa.RecordBatch]:
    for batch, texts in arrays.slices(batches, "text"):
        found = _Windows(texts, width)
        first, many = found.blocks()
        yes = sketch.repeated(found.runs[found.chosen[first]]) if len(first) else first.astype(bool)
        first, many = first[yes], many[yes]
        if not len(first):
            continue
        b1, b2 = found.hashed(found.start[first], many + width - 1)
        columns = {"b1": b1.view(np.int64), "b2": b2.view(np.int64)}
        if with_windows:
            inside = np.repeat(first - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
            pairs = np.stack(found.hashed(found.start[inside], width), axis=1)
            ends = np.concatenate(([0], np.cumsum(many) * 16)).astype(np.int32)
            columns["windows"] = pa.Array.from_buffers(
                pa.binary(), len(many), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(pairs))]
            )
        else:
            doc = found.doc[first]
            columns["id"] = batch.column(0).take(pa.array(doc))
            columns["mark"] = batch.column(1).take(pa.array(doc))
            columns["at"] = (found.start[first] - found.offsets[doc]).astype(np.int32)
        yield pa.RecordBatch.from_pydict(columns)


def _expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of each distinct block."""
    for batch in batches:
        sizes = np.array([len(x) // 16 for x in batch.column(3).to_pylist()], dtype=np.int64)
        pairs = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.int64).reshape(-1, 2)
        row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        place = np.arange(len(pairs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.ascontiguousarray(pairs[:, 0])),
                pa.array(np.ascontiguousarray(pairs[:, 1])),
                batch.column(0).take(row),
                batch.column(1).take(row),
                pa.array(place.astype(np.int32)),
                batch.column(2).take(row),
            ],
            names=["w1", "w2", "b1", "b2", "place", "n"],
        )


def repeated_windows(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, bits: int = BITS
) -> DataFrame:
    """``(id, mark, starts)``: word numbers at which repeated windows start, per text.

    ``starts`` is a list of ``(at, mask)``: bit p of the mask says that the window that
    starts p words after ``at`` is repeated.
    """
    if not 2 <= width <= 63:
        raise ValueError("a window has 2 to 64 words")
    spark = docs.sparkSession
    source = docs.select(id_of(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, texts in arrays.slices(batches, "text"):
            found = _Windows(texts, width)
            first, _ = found.blocks()
            yield found.runs[found.chosen[first]]

    sketch = spark.sparkContext.broadcast(build(source.select("text"), chosen, bits, DEPTH))
    blocks = stored(
        source.mapInArrow(
            lambda b: _occurrences(b, width, sketch.value, True), "b1 long, b2 long, windows binary"
        )
        .groupBy("b1", "b2")
        .agg(F.least(F.count("*"), F.lit(2)).cast("int").alias("n"), F.first("windows").alias("windows")),
        "blocks",
    )
    windows = blocks.select("b1", "b2", "n", "windows").mapInArrow(
        _expand, "w1 long, w2 long, b1 long, b2 long, place int, n int"
    )
    # Blocks found twice are repeated as a whole; their windows only tell about others'.
    repeated = (
        windows.groupBy("w1", "w2")
        .agg(F.sum("n").alias("all"), F.min("n").alias("least"))
        .where("all > 1 AND least = 1")
        .select("w1", "w2", F.xxhash64("w1", "w2").alias("w"))
    )
    masks = (
        windows.where("n = 1")
        .withColumn("w", F.xxhash64("w1", "w2"))
        .join(repeated, ["w", "w1", "w2"])
        .groupBy("b1", "b2")
        .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask"))
        .unionByName(
            blocks.where("n > 1").select(
                "b1", "b2", F.expr("shiftleft(1L, CAST(octet_length(windows) DIV 16 AS INT)) - 1").alias("mask")
            )
        )
        .withColumn("b", F.xxhash64("b1", "b2"))
    )
    places = source.mapInArrow(
        lambda b: _occurrences(b, width, sketch.value, False), "b1 long, b2 long, id long, mark long, at int"
    )
    # The hashes as further keys make both sides of a join be dealt out for it, so that
    # Spark can split the part of a frequent block or window.
    return (
        places.withColumn("b", F.xxhash64("b1", "b2"))
        .join(masks, ["b", "b1", "b2"])
        .select("id", places["mark"], F.struct("at", masks["mask"]).alias("start"))
        .groupBy("id", "mark")
        .agg(F.collect_list("start").alias("starts"))
    )


def drop_repeated_windows(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    width: int = WIDTH,
    bits: int = BITS,
    n_words: str = "n_words",
    n_removed: str = "n_removed",
) -> DataFrame:
    """The documents with the words left over, joined by one space, and both counts.

    A null text stays null. A count whose name is taken gets an underscore at its end.
    """
    n_words, n_removed = unused(docs, n_words), unused(docs, n_removed)
    starts = repeated_windows(docs, text, doc_id, width, bits).select(
        F.col("id").alias("_at_id"), F.col("mark").alias("_at_mark"), F.col("starts").alias("_starts")
    )
    joined = docs.join(
        starts, (id_of(doc_id) == F.col("_at_id")) & (F.xxhash64(text) == F.col("_at_mark")), "left"
    ).select(*[docs[c] for c in docs.columns], "_starts")
    at = docs.columns.index(text)
    names = [*docs.columns, n_words, n_removed]

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, lost = [], [], []
            found = batch.column(batch.num_columns - 1).to_pylist()
            missing = batch.column(at).is_null().to_pylist()
            for t, blocks, null in zip(arrays.texts_of(batch.column(at)), found, missing):
                own = t.split()
                total.append(len(own))
                if blocks:
                    keep = keep_words(len(own), [(b["at"], b["mask"]) for b in blocks], width)
                    lost.append(len(own) - int(keep.sum()))
                    own = compress(own, keep)
                else:
                    lost.append(0)
                kept.append(None if null else b" ".join(own))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(lost, pa.int64())], names=names
            )

    return joined.mapInArrow(apply, with_fields(docs.schema, (n_words, T.LongType()), (n_removed, T.LongType())))


def keep_words(n: int, blocks: list[tuple[int, int]], width: int) -> np.ndarray:
    """Which of n words are outside all windows that the blocks name."""
    at, mask = (np.array(x, dtype=np.int64) for x in zip(*blocks))
    bit, place = np.nonzero((mask[:, None] >> np.arange(64)) & 1)
    change = np.zeros(n + width + 1, dtype=np.int64)
    start = at[bit] + place
    np.add.at(change, start, 1)
    np.add.at(change, start + width, -1)
    return np.cumsum(change)[:n] == 0
