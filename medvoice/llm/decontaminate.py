"""Benchmark decontamination: where passages of benchmark items occur in documents.

Each task cuts its documents into shards of a few MB and builds an FM-index of each: a
suffix array of the word numbers, its Burrows-Wheeler transform in a wavelet matrix with
ranks, and the suffix positions that are multiples of a step. All phrases are searched
backwards at once; rows found are walked to the next kept position, which gives the
places, and overlapping places are merged to spans.

Words that no phrase has cannot be part of an occurrence: they become one separator, and
what lies between separators and is shorter than the shortest phrase is left out of the
index. Nothing else is: all words of all texts are read.

Benchmark items come to the tasks in blocks of at most about ``BLOCK`` bytes of text
(one item at least); documents pass through all blocks one after the other without a
shuffle. Documents and items without words (null, empty) have no occurrences. Items of
one id count once, and so do all items without an id: their words are hit as well, and
stand as one null at the end of the items. All columns of the documents are kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medvoice.llm import arrays
from medvoice.llm.frames import unused, with_fields

WINDOW = 13
BLOCK = 8 << 20
STEP = 8

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by doubling the sorted length; the last symbol is unique."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    length = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - length if length < n else 0] = rank[length:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        length *= 2


class Wavelet:
    """Wavelet matrix: how often a symbol occurs before a place."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1
            before = np.concatenate(([0], np.cumsum(ones))).astype(np.int32)
            self.levels.append((bit, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        start, end = np.zeros_like(place), place
        for bit, ones, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            start = np.where(one, zeros + ones[start], start - ones[start])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - start


class Index:
    """FM-index of word numbers; 0 ends the text, other numbers are from 1 to ``top``."""

    def __init__(self, symbols: np.ndarray, top: int):
        order = suffix_array(symbols)
        self.last = symbols[order - 1]
        self.wavelet = Wavelet(self.last, top)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=top + 1)))).astype(np.int64)
        self.kept = order % STEP == 0
        self.positions = order[self.kept]
        self.kept_before = np.cumsum(self.kept) - 1
        self.size = len(symbols)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each phrase (all of one length)."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        for at in range(phrases.shape[1] - 1, -1, -1):
            alive = np.flatnonzero(low < high)
            if not len(alive):
                break
            symbol = phrases[alive, at]
            low[alive] = self.before[symbol] + self.wavelet.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.wavelet.rank(symbol, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, by walking to a kept one."""
        rows, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        open_ = np.flatnonzero(~self.kept[rows])
        while len(open_):
            symbol = self.last[rows[open_]]
            rows[open_] = self.before[symbol] + self.wavelet.rank(symbol, rows[open_])
            steps[open_] += 1
            open_ = open_[~self.kept[rows[open_]]]
        return self.positions[self.kept_before[rows]] + steps


class Phrases:
    """Windows of some items as numbers of known words."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        texts = [t for _, t in items]
        found = arrays.words(texts, arrays.ALNUM, lower=True)
        offsets = found.of_doc(len(texts))
        self.known, first, number = np.unique(found.hash, return_index=True, return_inverse=True)
        lowered = [t.translate(arrays.LOWER) for t in texts]
        self.spelled = [lowered[found.doc[i]][found.start[i] : found.end[i]] for i in first]
        number = number + 2  # 0 ends a text, 1 separates
        owners: dict[tuple[int, ...], set[str | None]] = defaultdict(set)
        for d, (item, _) in enumerate(items):
            own = tuple(number[offsets[d] : offsets[d + 1]].tolist())
            for at in range(max(1, len(own) - window + 1) if own else 0):
                owners[own[at : at + window]].add(item)
        by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for phrase in owners:
            by_length[len(phrase)].append(phrase)
        self.by_length = {n: (np.array(ps, dtype=np.int64), [by_name(owners[p]) for p in ps]) for n, ps in by_length.items()}
        self.shortest = min(by_length, default=0)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, 1 for unknown words."""
        if not len(self.known):
            return np.ones(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at + 2, 1)


def occurrences(texts: list[bytes], phrases: Phrases) -> tuple[np.ndarray, list[tuple[int, int, int, list[str | None]]]]:
    """Number of words of each text, and ``(text, first word, end, items)`` of what was found."""
    found = arrays.words(texts, arrays.ALNUM, lower=True)
    offsets = found.of_doc(len(texts))
    counts = np.diff(offsets)
    if not len(found.hash) or not phrases.by_length:
        return counts, []
    number = phrases.numbers(found.hash)
    known = number > 1
    if not known.any():
        return counts, []
    starts_run = known & ~np.concatenate(([False], known[:-1] & (found.doc[1:] == found.doc[:-1])))
    run = np.cumsum(starts_run) - 1
    sizes = np.bincount(run[known], minlength=int(starts_run.sum()))
    keep = np.flatnonzero(known & (sizes[np.maximum(run, 0)] >= phrases.shortest))
    if not len(keep):
        return counts, []
    # Known runs one after the other, a separator after each.
    cut = np.flatnonzero(np.concatenate((run[keep][1:] != run[keep][:-1], [True]))) + 1
    symbols = np.concatenate((np.insert(number[keep], cut, 1), [0]))
    places = np.concatenate((np.insert(keep, cut, -1), [-1]))
    index = Index(symbols, len(phrases.known) + 1)
    out = []
    lowered: dict[int, bytes] = {}
    for length, (wanted, owners) in phrases.by_length.items():
        low, high = index.search(wanted)
        hit = np.flatnonzero(low < high)
        if not len(hit):
            continue
        many = (high - low)[hit]
        rows = np.repeat(low[hit] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        for which, at in zip(np.repeat(hit, many), places[index.locate(rows)]):
            d = int(found.doc[at])
            if d not in lowered:
                lowered[d] = texts[d].translate(arrays.LOWER)
            # The words themselves decide: a hash alone does not make an occurrence.
            if all(
                lowered[d][found.start[at + i] : found.end[at + i]] == phrases.spelled[wanted[which, i] - 2]
                for i in range(length)
            ):
                out.append((d, int(at - offsets[d]), int(at - offsets[d] + length), owners[which]))
    return counts, out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def by_name(items: set[str | None]) -> list[str | None]:
    """The items in order, null at the end."""
    return sorted(items, key=lambda x: (x is None, x or ""))


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in blocks of bounded size, one block on the driver at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where(
        "text IS NOT NULL"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // BLOCK))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield [(r["item"], r["text"].encode()) for r in part.collect()]


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The documents with ``n_words, n_hit, spans, items``.

    ``spans`` are ranges of words (end excluded) inside occurrences, merged; ``items``
    the ids of the items that occur, sorted as strings, with a null at the end if one
    without an id occurs. A name that is taken gets an
    underscore at its end.
    """
    added = [unused(docs, n) for n in ("n_words", "spans", "items")]
    at = docs.columns.index(text)
    base = len(docs.columns)
    schema = with_fields(
        docs.schema, (added[0], T.LongType()), (added[1], SPANS), (added[2], T.ArrayType(T.StringType()))
    )
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    names = [*docs.columns, *added]
    out, spark = docs, docs.sparkSession

    def search(held) -> object:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in arrays.slices(batches, names[at]):
                counts, found = occurrences(texts, held.value)
                if batch.num_columns > base:
                    spans = [[(s["start"], s["end"]) for s in x] for x in batch.column(base + 1).to_pylist()]
                    items = [set(x) for x in batch.column(base + 2).to_pylist()]
                else:
                    spans, items = [[] for _ in texts], [set() for _ in texts]
                for d, start, end, owners in found:
                    spans[d].append((start, end))
                    items[d].update(owners)
                ranges = [[{"start": a, "end": b} for a, b in merge(x)] for x in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i) for i in range(base)),
                        pa.array(counts, pa.int64()),
                        pa.array(ranges, span_type),
                        pa.array([by_name(x) for x in items], pa.list_(pa.string())),
                    ],
                    names=names,
                )

        return run

    for block in _blocks(benchmark, item_id, item_text):
        out = out.mapInArrow(search(spark.sparkContext.broadcast(Phrases(block, window))), schema)
    hits = F.aggregate(added[1], F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return out.withColumn(unused(out, "n_hit"), hits)


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least a twentieth of the words lies inside occurrences."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
