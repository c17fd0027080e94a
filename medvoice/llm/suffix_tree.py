"""LM scoring with a probabilistic suffix tree over words.

Symbols are the words that occur often enough in the training texts, the end of a text,
and one symbol for all other words. The tree's root is the smoothed unigram distribution;
inside the symbol for other words they keep their unigram proportions, so a tree of
nothing but the root gives exactly the base score.

A context of one to ``depth`` symbols is tested if it occurs often enough, with the next
symbols that occur often enough after it. It is kept if the distribution after it diverges
from the one after its longest kept suffix by enough to gain ``GAIN`` nats on the training
tokens. Next symbols have their counts smoothed by the distribution of the suffix, the rest
of the probability goes to the other symbols as the suffix has them. A text's words are
scored by the longest kept context before each.

"Often enough" is a number of times that rises more slowly than the corpus: a constant
(``SYMBOL``, ``CONTEXT``, ``JOINT``) times the training tokens to the power of ``POWER``,
and a few at least. So symbols, contexts and next symbols grow without end, with the power
of 0.4 of the tokens: 16 times as many for a corpus 1,000 times as large. They are part of
what every task holds: of 10**13 tokens at most 3 * 10**7 next symbols of one length, of 16
bytes each, and a tenth of that where words are as uneven as in natural text.

All counts are over all training texts: those of symbols and contexts are summed in the
tasks and then by key, those of other words meet the documents in one shuffle by word.
Texts are cut into words twice: to name the words that may be symbols, and to write each
text's symbols and other words as numbers, which all that follows reads.
Words are told apart by 64 bits, rows by 64 bits of id and text; equal rows share counts.
A null text has no words and one end. A missing id is held out of nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medvoice.llm import arrays
from medvoice.llm.frames import forget, stored

SYMBOL, CONTEXT, JOINT, POWER = 0.002, 0.02, 0.005, 0.6
DEPTH, LEAST, GAIN, SMOOTH = 3, 5, 20.0, 5.0
HELD = 4_000_000


def is_held_out(doc_id: str, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def often_enough(tokens: int, factor: float, least: float) -> float:
    """How often something must occur among so many tokens to be part of the tree."""
    return max(least, factor * tokens**POWER)


def _summed(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and their summed counts."""
    keys = np.concatenate([k for k, _ in pairs])
    values, number = np.unique(keys, return_inverse=True)
    return values, np.bincount(number, weights=np.concatenate([n for _, n in pairs]), minlength=len(values)).astype(np.int64)


def _counts(batch_keys: Iterable[np.ndarray], least_share: float | None = None) -> Iterator[pa.RecordBatch]:
    """Counts of a task's keys; with a share, only of keys of at least that share of them.

    A key that has a share of all keys has it in one of their parts at least, so a share
    loses none of those; their counts are to be made by another pass. With a share each
    count has the number of keys in its part, ``total``, which a row without a key has too.
    """
    held, size, total = [], 0, 0

    def out() -> pa.RecordBatch:
        keys, n = _summed(held)
        if least_share is None:
            return pa.RecordBatch.from_pydict({"key": keys.view(np.int64), "n": n})
        yes = n >= least_share * total
        keys, n = keys[yes].view(np.int64), n[yes]
        no_key = pa.nulls(1, pa.int64())
        return pa.RecordBatch.from_pydict(
            {
                "key": pa.concat_arrays([pa.array(keys), no_key]),
                "n": pa.concat_arrays([pa.array(n), no_key]),
                "total": np.full(len(n) + 1, total, dtype=np.int64),
            }
        )

    for keys in batch_keys:
        values, n = np.unique(keys, return_counts=True)
        held.append((values, n))
        size += len(values)
        total += len(keys)
        if size > HELD:
            held = [_summed(held)]
            size = len(held[0][0])
            if size > HELD // 2:
                yield out()
                held, size, total = [], 0, 0
    if held:
        yield out()


@dataclass
class Contexts:
    """Keys of contexts of one length, ascending; and which symbols they have 1, 2, ... places back."""

    keys: np.ndarray
    size: int
    marks: list[np.ndarray]

    @classmethod
    def of(cls, keys: np.ndarray, size: int, length: int) -> Contexts:
        marks = [np.zeros(size, dtype=bool) for _ in range(length)]
        for back, mark in enumerate(marks):
            mark[keys // size**back % size] = True
        return cls(keys, size, marks)

    def before(self, symbols: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the contexts that stand before places of a text, and these places."""
        some = np.flatnonzero(place >= len(self.marks))
        for back, mark in enumerate(self.marks, 1):
            some = some[mark[symbols[some - back]]]
        key = np.zeros(len(some), dtype=np.int64)
        for back in range(len(self.marks), 0, -1):
            key = key * self.size + symbols[some - back]
        at = place_in(self.keys, key)
        return at[at >= 0], some[at >= 0]


@dataclass
class Tree:
    """Known words (ascending hashes) and the tree over symbol numbers.

    Symbols 0 to len(words) - 1 are words, then come the end and the other words.
    """

    words: np.ndarray
    counts: np.ndarray
    root: np.ndarray
    #: Per kept context: its key, parent (-1: root), and log10 of what unkept symbols get.
    contexts: list[np.ndarray] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    parents: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    rest: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: ``context * symbols + symbol`` in ascending order, and log10 probabilities.
    entries: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def size(self) -> int:
        return len(self.words) + 2

    def symbols(self, texts: list[bytes]) -> tuple[arrays.Words, np.ndarray, np.ndarray]:
        """Words; and the symbols of the texts, each ended, with the offsets of the texts."""
        found = arrays.words(texts, lower=True)
        known = place_in(self.words, found.hash)
        number = np.where(known >= 0, known, len(self.words) + 1)
        offsets = found.of_doc(len(texts))
        every = np.insert(number, offsets[1:], len(self.words))
        return found, every, offsets + np.arange(len(texts) + 1)

    @cached_property
    def known(self) -> list[Contexts]:
        return [Contexts.of(c, self.size, length) for length, c in enumerate(self.contexts, 1)]

    def states(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The longest kept context before each place, -1 for the root."""
        state = np.full(len(symbols), -1, dtype=np.int64)
        for known, first in zip(self.known, self.first):
            at, some = known.before(symbols, place)
            state[some] = at + first
        return state

    def log10(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Probability of each symbol after each context."""
        out = np.zeros(len(symbol))
        state, todo = state.copy(), np.arange(len(symbol))
        while len(todo):
            rooted = state[todo] < 0
            out[todo[rooted]] += self.root[symbol[todo[rooted]]]
            todo = todo[~rooted]
            at = place_in(self.entries, state[todo] * self.size + symbol[todo])
            hit = at >= 0
            out[todo[hit]] += self.values[at[hit]]
            todo = todo[~hit]
            out[todo] += self.rest[state[todo]]
            state[todo] = self.parents[state[todo]]
        return out


def place_in(ascending: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value, -1 for values that are not there."""
    if not len(ascending):
        return np.full(len(values), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return np.where(ascending[at] == values, at, -1)


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The bytes of ``values[offsets[i]:offsets[i + 1]]`` as row i."""
    ends = (offsets * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _numbers(rows: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that rows of bytes hold, in one array, and the row of each."""
    values = np.frombuffer(b"".join(rows), dtype=kind)
    sizes = np.fromiter((len(r) for r in rows), dtype=np.int64, count=len(rows)) // kind.itemsize
    return values, np.repeat(np.arange(len(rows)), sizes)


@dataclass
class Coded:
    """How the written symbols are read: their type, and the symbol of the tree for each."""

    kind: np.dtype
    words: np.ndarray
    symbol: np.ndarray

    def read(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        """Row ranges of the batches with the symbols as written, the row of each and its place in it."""
        for batch, rows in arrays.slices(batches, "symbols", arrays.PIECE * self.kind.itemsize):
            written, doc = _numbers(rows, self.kind)
            begin = np.searchsorted(doc, np.arange(len(rows)))
            yield batch, written, doc, np.arange(len(doc)) - begin[doc]

    def others(self, batch: pa.RecordBatch, written: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words that are no symbols of the tree, and the row of each."""
        hashed, of = _numbers(arrays.texts_of(batch.column(batch.schema.get_field_index("others"))), np.dtype(np.uint64))
        rare = self.symbol == self.symbol[-1]
        rare[-1] = False
        again = np.flatnonzero(rare[written])
        return np.concatenate((hashed, self.words[written[again]])), np.concatenate((of, doc[again]))


def _grow(tree: Tree, key: np.ndarray, symbol: np.ndarray, n: np.ndarray, all_: dict[int, int]) -> None:
    """Add the contexts of one more symbol that diverge enough; pairs are in order of key, symbol."""
    length = len(tree.contexts) + 1
    keys, start = np.unique(key, return_index=True)
    total = np.array([all_[int(k)] for k in keys], dtype=float)
    # The longest kept suffix of each context.
    parent = np.full(len(keys), -1, dtype=np.int64)
    for shorter in range(1, length):
        at = place_in(tree.contexts[shorter - 1], keys % tree.size**shorter)
        parent = np.where(at >= 0, at + tree.first[shorter - 1], parent)
    owner = np.repeat(np.arange(len(keys)), np.diff(np.append(start, len(key))))
    before = 10.0 ** tree.log10(parent[owner], symbol)
    after = (n + SMOOTH * before) / (total[owner] + SMOOTH)
    kept_before = np.minimum(np.bincount(owner, weights=before, minlength=len(keys)), 1 - 1e-12)
    kept_after = np.minimum(np.bincount(owner, weights=after, minlength=len(keys)), 1 - 1e-12)
    divergence = np.bincount(owner, weights=after * np.log(after / before), minlength=len(keys)) + (1 - kept_after) * np.log(
        (1 - kept_after) / (1 - kept_before)
    )
    keep = total * divergence >= GAIN
    number = np.cumsum(keep) - 1 + len(tree.parents)
    tree.contexts.append(keys[keep])
    tree.first.append(len(tree.parents))
    tree.parents = np.concatenate((tree.parents, parent[keep]))
    tree.rest = np.concatenate((tree.rest, np.log10((1 - kept_after) / (1 - kept_before))[keep]))
    yes = keep[owner]
    tree.entries = np.concatenate((tree.entries, number[owner][yes] * tree.size + symbol[yes]))
    tree.values = np.concatenate((tree.values, np.log10(after[yes])))


class Model:
    """Counts and tree of a table's training rows, and scores of all of its rows."""

    def __init__(
        self,
        docs: DataFrame,
        train: Column,
        text: str = "text",
        doc_id: str = "doc_id",
        depth: int = DEPTH,
        symbol: float = SYMBOL,
        context: float = CONTEXT,
        joint: float = JOINT,
    ):
        self.source = docs.select(
            F.col(doc_id).alias("id"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
            train.alias("train"),
        ).withColumn("row", F.xxhash64("id", "text"))
        training = self.source.where("train").select("text")
        spark = docs.sparkSession

        # A text has a word in two bytes at most; the words that may be often enough among so
        # many are counted, and those kept that are among as many as there are.
        sizes = training.agg(F.count("*").alias("docs"), F.sum((F.octet_length("text") + 1).cast("long")).alias("bytes")).first()
        self.ends = sizes["docs"]

        def word_share(tokens: int) -> float:
            return often_enough(tokens, symbol, 2) / max(1, tokens)

        share = word_share((sizes["bytes"] or 0) // 2 + self.ends)

        def word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _counts((arrays.words(t, lower=True).hash for _, t in arrays.slices(batches, "text")), share)

        counted = stored(training.mapInArrow(word_counts, "key long, n long, total long"), "words")
        self.tokens = (counted.where("key IS NULL").agg(F.sum("total")).first()[0] or 0) + self.ends
        least = {k: often_enough(self.tokens, f, low) for k, f, low in (("word", symbol, 2), ("context", context, LEAST), ("joint", joint, LEAST))}
        # Words that may be often enough; the pass over symbols counts them.
        named = counted.where(F.col("n") >= word_share(self.tokens) * F.col("total")).select("key").distinct().toArrow()
        forget(counted)
        words = np.sort(named.column("key").to_numpy().view(np.uint64))
        none = np.zeros(0)
        self.tree = Tree(words, none, none)
        size = self.tree.size
        self.coded = Coded(np.dtype(np.uint16 if size <= 1 << 16 else np.uint32), words, np.arange(size))
        self._write_symbols()
        training = self.written.where("train").select("symbols")
        usable = np.ones(0, dtype=np.int64)
        for length in range(depth + 1):
            # Symbols alone, then next symbols after the candidates of each length.
            held = spark.sparkContext.broadcast((self.coded, Contexts.of(usable, size, length)))

            def pair_counts(batches: Iterable[pa.RecordBatch], length: int = length, held=held) -> Iterator[pa.RecordBatch]:
                def keys() -> Iterator[np.ndarray]:
                    coded, candidates = held.value
                    for _, written, _, place in coded.read(batches):
                        if not length:
                            yield written.astype(np.int64)
                            continue
                        every = coded.symbol[written]
                        at, some = candidates.before(every, place)
                        yield at * candidates.size + every[some]

                return _counts(keys())

            counted = stored(
                training.mapInArrow(pair_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "counts"
            )
            if not length:
                got = counted.toArrow()
                counts = np.zeros(size, dtype=np.int64)
                counts[got.column("key").to_numpy()] = got.column("n").to_numpy()
                forget(counted)
                # Named words that are not often enough after all are other words.
                often = counts[:-2] >= least["word"]
                rare = counts[:-2][~often].sum()
                words = words[often]
                symbol_of = np.where(often, np.cumsum(often) - 1, len(words) + 1)
                self.coded.symbol = np.concatenate((symbol_of, [len(words), len(words) + 1]))
                counts = np.concatenate((counts[:-2][often], [counts[-2], counts[-1] + rare]))
                self.tree = Tree(words, counts, none)
                size = self.tree.size
                self._count_other_words()
                usable = np.flatnonzero(counts >= least["context"]).astype(np.int64)
                usable = usable[usable != len(words)]  # nothing follows the end
                continue
            totals = counted.groupBy(F.expr(f"key div {size}").alias("c")).agg(F.sum("n").alias("n")).toArrow()
            pairs = counted.where(F.col("n") >= least["joint"]).toArrow()
            forget(counted)
            order = np.argsort(pairs.column("key").to_numpy())
            key, n = pairs.column("key").to_numpy()[order], pairs.column("n").to_numpy()[order]
            all_ = {int(usable[c]): t for c, t in zip(totals.column("c").to_pylist(), totals.column("n").to_pylist())}
            if not len(key):
                break
            whole = usable[key // size]
            _grow(self.tree, whole, key % size, n, all_)
            longer = (n >= least["context"]) & (key % size != len(words))
            # Longer contexts end with a context that was a candidate; keys stay ascending.
            usable = np.sort(whole[longer] * size + key[longer] % size)
            if not len(usable):
                break

    def _write_symbols(self) -> None:
        """All rows with their symbols and the hashes of their other words, as bytes."""
        held = self.source.sparkSession.sparkContext.broadcast((self.tree, self.coded.kind))

        def symbols(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, kind = held.value
            for batch, texts in arrays.slices(batches, "text"):
                found, every, offsets = tree.symbols(texts)
                other = every == tree.size - 1
                upto = np.concatenate(([0], np.cumsum(other)))[offsets]
                # Words stand in the order of the symbols, without the ends.
                hashed = found.hash[other[every != tree.size - 2]]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(3)), _binary(every.astype(kind), offsets), _binary(hashed, upto)],
                    names=["id", "row", "train", "symbols", "others"],
                )

        kind = self.source.schema["id"].dataType.simpleString()
        rows = self.source.select("id", "row", "train", "text").mapInArrow(
            symbols, f"id {kind}, row long, train boolean, symbols binary, others binary"
        )
        self.written = stored(rows, "symbols")

    def _count_other_words(self) -> None:
        """Sums over the other words of each row; distinct training words; the root."""
        held = self.source.sparkSession.sparkContext.broadcast(self.coded)
        names = ["word", "row", "n", "train"]

        def others(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, written, of, _ in held.value.read(batches):
                hashed, doc = held.value.others(batch, written, of)
                order = np.lexsort((hashed, doc))
                doc, hashed = doc[order], hashed[order]
                new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])))) if len(doc) else doc
                n = np.diff(np.append(new, len(doc)))
                at = pa.array(doc[new])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashed[new].view(np.int64)),
                        batch.column(0).take(at),
                        pa.array(n.astype(np.int32)),
                        batch.column(1).take(at),
                    ],
                    names=names,
                )

        word = Window.partitionBy("word")
        counted = (
            self.written.select("row", "train", "symbols", "others")
            .mapInArrow(others, "word long, row long, n int, train boolean")
            .withColumn("c", F.sum(F.when(F.col("train"), F.col("n")).otherwise(0)).over(word))
            .withColumn("turn", F.row_number().over(word.orderBy("row")))
        )
        known = F.col("c") > 0
        self.others = stored(
            counted.groupBy("row").agg(
                F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("other_log"),
                F.sum("n").alias("n_other"),
                F.sum(F.when(known, F.col("n")).otherwise(0)).alias("other_known"),
                F.count_if(known & (F.col("turn") == 1)).alias("distinct"),
            ),
            "others",
        )
        tree = self.tree
        named = tree.counts[:-1]  # words and the end
        self.distinct = int((named > 0).sum()) + (self.others.agg(F.sum("distinct")).first()[0] or 0)
        #: The denominator of the base score, and the part of it for the other words.
        self.whole = self.tokens + 0.5 * (self.distinct + 1)
        self.other_whole = max(self.whole - float((named + 0.5).sum()), 0.5)
        root = np.append(named + 0.5, self.other_whole)
        tree.root = np.log10(root / self.whole)

    def scores(self) -> DataFrame:
        """``(id, n_tokens, n_known, train_tokens, base_score, score)`` for every row."""
        held = self.source.sparkSession.sparkContext.broadcast((self.tree, self.coded))

        def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, coded = held.value
            named_log = np.append(np.log10(tree.counts[:-1] + 0.5), 0.0)
            known = np.append(tree.counts[:-1] > 0, False)
            for batch, written, doc, place in coded.read(batches):
                every = coded.symbol[written]
                n = batch.num_rows
                by_doc = lambda w: np.bincount(doc, weights=w, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(np.bincount(doc, minlength=n)),
                        pa.array(by_doc(known[every]).astype(np.int64)),
                        pa.array(by_doc(named_log[every])),
                        pa.array(by_doc(tree.log10(tree.states(every, place), every))),
                    ],
                    names=["id", "row", "n_tokens", "known", "named_log", "symbol_log"],
                )

        kind = self.source.schema["id"].dataType.simpleString()
        rows = self.written.select("id", "row", "symbols").mapInArrow(
            score, f"id {kind}, row long, n_tokens long, known long, named_log double, symbol_log double"
        )
        same = F.count("*").over(Window.partitionBy("row"))
        other = lambda name: F.coalesce(F.col(name) / F.col("same"), F.lit(0.0))
        return (
            rows.withColumn("same", same)
            .join(self.others.hint("merge"), "row", "left")
            .select(
                "id",
                "n_tokens",
                (F.col("known") + other("other_known").cast("long")).alias("n_known"),
                F.lit(self.tokens).cast("long").alias("train_tokens"),
                (F.col("named_log") + other("other_log") - F.col("n_tokens") * float(np.log10(self.whole))).alias("base_score"),
                (F.col("symbol_log") + other("other_log") - other("n_other") * float(np.log10(self.other_whole))).alias("score"),
            )
        )
