"""Suffix-array dedup: bytes inside a string of ``length`` that an earlier document has too.

Suffixes are compared in the order of a suffix array made by the difference cover
algorithm: triples of the positions not divisible by three are sorted and named, the
names form a string that is sorted likewise, the other suffixes are merged in by a
character and a rank, and neighbours whose first ``length`` bytes agree are one string.

The work is divided so that equal strings always meet. A string's key is the run of
``gram`` bytes of least hash inside it, a place that any two equal strings share as the
shifts of a difference cover are shared, but with one place in sixteen. Strings of one
key that start next to each other form a context.

1. All keys are counted; strings whose key occurs once are unique, and are dropped by a
   filter of the other keys.
2. Neighbouring contexts that are left form blocks, which end where a key's hash says so
   (about every eighth), so that equal passages have equal blocks but at their ends. Blocks
   are grouped by 128 bits of their bytes: copies, however many, become one row with their
   smallest document. In all other documents that hold the block, all its strings go.
3. What is left to find out is which strings of a distinct block an even earlier document
   holds in another block. The contexts of distinct blocks whose key occurs in several
   places meet by key, and their suffixes are sorted, a batch of keys at a time. Contexts of
   a key with more than ``many`` of them are cut into single strings, which are grouped.
4. Every occurrence of a block learns its smallest document and, if that is its own, the
   strings to remove; overlapping ones are merged to spans.

What a step shuffled and stored is deleted before the next ones need the disk.

Texts are UTF-8 bytes, null is empty. Rows of one id are one document; a missing id
comes last. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medvoice.llm import arrays
from medvoice.llm.frames import forget, id_of, shuffles_deleted, stored, unused, with_fields
from medvoice.llm.repeats import TOLD, Repeated, build

LENGTH, GRAM = 50, 20
#: A task holds so many times 2**BITS bits of the filter of keys at once.
BITS, DEPTH = 27, 3
#: Bytes of text looked at together (arrays of that length fit in a cache), taken, and sorted.
PIECE = 1 << 16
SLICE = 1 << 20
SORTED = 1 << 20
#: Contexts of one key that a task sorts at once, some 3 MB of them.
MANY = 50_000
#: A block ends behind one context in so many, and after the most at the latest.
CUT, MOST = 8, 64


# -- Suffix order -----------------------------------------------------------------


def _names(*columns: np.ndarray) -> np.ndarray:
    """Ascending numbers of the different rows, from 1."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    for c in columns:
        ordered = c[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a row of numbers from 1."""
    n = len(s)
    if n < 3:
        return np.lexsort([np.append(s, [0, 0])[k : k + n] for k in (1, 0)])
    t = np.concatenate((s, np.zeros(4, dtype=np.int64)))
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    # Sort the sampled triples.
    small = max(int(s.max()), n) < (1 << 21) - 2
    if small:
        packed = (t[sample] << 42) | (t[sample + 1] << 21) | t[sample + 2]
        named = np.unique(packed, return_inverse=True)[1] + 1
    else:
        named = _names(t[sample], t[sample + 1], t[sample + 2])
    # Recurse on their names unless they are all different.
    if int(named.max()) < len(sample):
        order = suffix_order(named)
        place = np.empty(len(sample), dtype=np.int64)
        place[order] = np.arange(1, len(sample) + 1)
    else:
        place = named
        order = np.argsort(named, kind="stable")
    rank = np.zeros(n + 4, dtype=np.int64)
    rank[sample] = place
    sampled = sample[order]
    sampled = sampled[sampled < n]
    # Sort the other suffixes by a character and the rank behind it.
    top = np.int64(len(sample) + 2)
    rest = np.arange(0, n, 3)
    key = t[rest] * top + rank[rest + 1]
    rest = rest[np.argsort(key, kind="stable")]
    # Merge: how many sampled suffixes of either kind come before each of the others.
    first, second = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(t[first] * top + rank[first + 1], t[rest] * top + rank[rest + 1])
    if small:
        before = before + np.searchsorted(*((t[x] << 42) | (t[x + 1] << 21) | rank[x + 2] for x in (second, rest)))
    else:
        pairs = _names(np.concatenate((t[second], t[rest])), np.concatenate((t[second + 1], t[rest + 1])))
        before = before + np.searchsorted(
            pairs[: len(second)] * top + rank[second + 2], pairs[len(second) :] * top + rank[rest + 2]
        )
    out = np.empty(n, dtype=np.int64)
    at = before + np.arange(len(rest))
    out[at] = rest
    others = np.ones(n, dtype=bool)
    others[at] = False
    out[others] = sampled
    return out


def _spelled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, one value after the other, and where each begins and the last ends."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets.astype(np.int64) - offsets[0]


def earliest(contexts: pa.Array, ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``length`` the least id among equal strings; and each context's first one."""
    text, offsets = _spelled(contexts)
    first, sizes = offsets[:-1], np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.arange(len(text)) - first[owner] <= sizes[owner] - length
    order = suffix_order(text.astype(np.int64) + 1)
    order = order[starts[order]]
    # Compare the prefixes of neighbours, eight bytes at a time.
    padded = np.concatenate((text, np.zeros(8, dtype=np.uint8)))
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(text)].copy().view(np.uint64).ravel()
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for k in sorted({*range(0, length - 7, 8), length - 8}):
        part = eights[order + k]
        same &= part[1:] == part[:-1]
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    least = np.minimum.reduceat(ids[owner[order]], heads)
    out = np.zeros(len(text), dtype=np.int64)
    out[order] = np.repeat(least, np.diff(np.append(heads, len(order))))
    return out[starts], np.cumsum(sizes - length + 1) - (sizes - length + 1)


# -- Contexts ---------------------------------------------------------------------


class _Contexts:
    """The contexts of some texts: text number, first byte, strings in it, key."""

    def __init__(self, parts: list[tuple[int, int, bytes]], length: int, gram: int):
        joined = b"".join(p for _, _, p in parts)
        self.joined, self.length = joined, length
        data = np.frombuffer(joined, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        n = len(data)
        up, down = arrays.powers(arrays.BYTE_BASES[0], n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(data * up[:n], out=sums[1:])
        # Stirred enough to order the runs by; only those that are chosen are mixed to keys.
        grams = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(arrays.BYTE_BASES[1])
        place = np.uint64((1 << 24) - 1)
        least = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
        have, reach = 1, length - gram + 1
        while have < reach:
            step = min(have, reach - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        sizes = np.array([len(p) for _, _, p in parts], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        valid = np.zeros(len(least), dtype=bool)
        for b, size in zip(begin, sizes):
            valid[b : b + size - length + 1] = True
        start = np.flatnonzero(valid)
        chosen = (least[start] & place).astype(np.int64)
        new = np.ones(len(start), dtype=bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)
        head = np.flatnonzero(new)
        self.many = np.diff(np.append(head, len(start)))
        self.start = start[head]
        self.key = arrays.mix(grams[chosen[head]])
        part = np.searchsorted(begin, self.start, side="right") - 1
        self.doc = np.array([d for d, _, _ in parts], dtype=np.int64)[part]
        self.at = self.start - begin[part] + np.array([a for _, a, _ in parts], dtype=np.int64)[part]

    def only(self, yes: np.ndarray) -> _Contexts:
        for name in ("many", "start", "key", "doc", "at"):
            setattr(self, name, getattr(self, name)[yes])
        return self

    def texts(self) -> list[bytes]:
        return [self.joined[s : s + m + self.length - 1] for s, m in zip(self.start, self.many)]

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """First context and number of strings of each block of the contexts that are left."""
        n = len(self.key)
        if not n:
            return self.start, self.many
        apart = np.ones(n, dtype=bool)
        apart[1:] = (self.start[1:] != self.start[:-1] + self.many[:-1]) | (self.key[:-1] % np.uint64(CUT) == 0)
        first = np.flatnonzero(apart)
        # Runs without an end of their own are cut by number.
        place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        first = np.flatnonzero(place % MOST == 0)
        return first, np.add.reduceat(self.many, first)


def contexts_of(texts: list[bytes], length: int, gram: int) -> Iterator[_Contexts]:
    """Contexts of whole texts, in pieces; a long text's pieces share ``length - 1`` bytes."""
    held, size = [], 0
    for d, text in enumerate(texts):
        for a in range(0, max(len(text) - length + 1, 0), PIECE):
            part = text[a : a + PIECE + length - 1]
            if held and size + len(part) > PIECE + length:
                yield _Contexts(held, length, gram)
                held, size = [], 0
            held.append((d, a, part))
            size += len(part)
    if held:
        yield _Contexts(held, length, gram)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _repeated(batches: Iterable[pa.RecordBatch], column: str, length: int, gram: int, repeated: Repeated) -> Iterator[tuple[pa.RecordBatch, _Contexts]]:
    """The rows' contexts whose keys are reported, in pieces, each with the batch of its rows."""
    every = ((batch, found) for batch, texts in arrays.slices(batches, column, SLICE) for found in contexts_of(texts, length, gram))
    for some in repeated.together(every, lambda x: len(x[1].key)):
        ends = np.cumsum([len(found.key) for _, found in some])
        yes = np.split(repeated(np.concatenate([found.key for _, found in some])), ends[:-1])
        for (batch, found), own in zip(some, yes):
            yield batch, found.only(own)


def _blocks(batches: Iterable[pa.RecordBatch], length: int, gram: int, repeated: Repeated, spelled: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of contexts whose keys are reported: with their bytes, or with their places."""
    for batch, found in _repeated(batches, "text", length, gram, repeated):
        first, many = found.blocks()
        if not len(first):
            continue
        start = found.start[first]
        spell = [found.joined[s : s + m + length - 1] for s, m in zip(start, many)]
        digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in spell), dtype=np.int64).reshape(-1, 2)
        doc = pa.array(found.doc[first])
        columns = {
            "b1": pa.array(np.ascontiguousarray(digest[:, 0])),
            "b2": pa.array(np.ascontiguousarray(digest[:, 1])),
            "id": batch.column(0).take(doc),
        }
        if spelled:
            columns["block"] = pa.array(spell, pa.binary())
        else:
            columns["mark"] = batch.column(1).take(doc)
            columns["at"] = pa.array(found.at[first])
        yield pa.RecordBatch.from_pydict(columns)


def _block_contexts(batches: Iterable[pa.RecordBatch], length: int, gram: int, repeated: Repeated) -> Iterator[pa.RecordBatch]:
    """Contexts of distinct blocks whose keys are reported, with their place."""
    for batch, found in _repeated(batches, "block", length, gram, repeated):
        if len(found.key):
            block = pa.array(found.doc)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": _signed(found.key),
                    "number": batch.column(0).take(block),
                    "first": batch.column(1).take(block),
                    "place": pa.array(found.at.astype(np.int32)),
                    "context": pa.array(found.texts(), pa.binary()),
                }
            )


CONTEXTS = "key long, number long, first long, place int, context binary"


def masks_of(key: np.ndarray, first: np.ndarray, contexts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings in each context, and which of them a context of a smaller document has (as bits)."""
    # Equal contexts are looked at once, for their smallest document.
    encoded = contexts.dictionary_encode()
    same, different = encoded.indices.to_numpy(), encoded.dictionary
    sizes = np.diff(_spelled(different)[1]) - length + 1
    smallest = np.full(len(different), np.iinfo(np.int64).max)
    np.minimum.at(smallest, same, first)
    # Only contexts that share a key with others need their suffixes sorted.
    at = np.zeros(len(different), dtype=key.dtype)
    at[same] = key
    _, group, times = np.unique(at, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(times[group] > 1)
    begin = np.cumsum(sizes) - sizes
    least = np.repeat(smallest, sizes)
    if len(mixed):
        found, offset = earliest(different.take(pa.array(mixed)), smallest[mixed], length)
        inside = np.arange(len(found)) - np.repeat(offset, sizes[mixed])
        least[np.repeat(begin[mixed], sizes[mixed]) + inside] = found
    many = sizes[same]
    head = np.cumsum(many) - many
    bit = np.arange(int(many.sum())) - np.repeat(head, many)
    earlier = least[np.repeat(begin[same], many) + bit] < np.repeat(first, many)
    return many, np.add.reduceat(earlier.astype(np.int64) << bit, head)


def _sorted(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Which strings of the contexts an even earlier document has; rows come in order of key."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        key, number, first, place = (rows.column(i).to_numpy() for i in range(4))
        many, mask = masks_of(key, first, rows.column(4).combine_chunks(), length)
        yes = np.flatnonzero(mask)
        return pa.RecordBatch.from_arrays(
            [pa.array(number[yes]), pa.array(place[yes]), pa.array(many[yes].astype(np.int32)), pa.array(mask[yes])],
            names=["number", "place", "many", "mask"],
        )

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(4).nbytes
        if size > SORTED:
            # All but the last key, of which more may come.
            rows = pa.Table.from_batches(held)
            key = rows.column(0).to_numpy()
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield solve(rows.slice(0, last))
            held = rows.slice(last).to_batches()
            size = sum(b.column(4).nbytes for b in held) if last else 0
    if held:
        yield solve(pa.Table.from_batches(held))


def _frequent_masks(contexts: DataFrame, length: int) -> DataFrame:
    """The same for keys of very many contexts: string by string of their different contexts, whatever the key."""
    different = contexts.groupBy("context").agg(F.min("first").alias("smallest"))
    strings = different.select(
        "context",
        "smallest",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.octet_length("context") - (length - 1)),
                lambda p: F.substring("context", p, F.lit(length)),
            )
        ).alias("bit", "string"),
    )
    least = strings.groupBy("string").agg(F.min("smallest").alias("least")).withColumn("s", F.xxhash64("string"))
    # Strings whose smallest document holds another context: what equal contexts do not tell.
    others = (
        strings.withColumn("s", F.xxhash64("string"))
        .join(least.hint("merge"), ["s", "string"])
        .where("least < smallest")
        .groupBy("context")
        .agg(F.map_from_entries(F.collect_list(F.struct("bit", "least"))).alias("others"))
    )
    known = different.join(others.hint("merge"), "context", "left").withColumn("c", F.xxhash64("context"))
    many = F.octet_length("context") - (length - 1)
    bits = F.transform(
        F.sequence(F.lit(0), many - 1),
        lambda k: F.when(
            F.coalesce(F.try_element_at("others", k), F.col("smallest")) < F.col("first"), F.call_function("shiftleft", F.lit(1).cast("long"), k)
        ).otherwise(F.lit(0).cast("long")),
    )
    return (
        contexts.withColumn("c", F.xxhash64("context"))
        .join(known.hint("merge"), ["c", "context"])
        .select("number", "place", many.alias("many"), F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a + b).alias("mask"))
        .where("mask <> 0")
    )


def repeated_strings(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    length: int = LENGTH,
    gram: int = GRAM,
    bits: int = BITS,
    many: int = MANY,
) -> DataFrame:
    """``(id, mark, starts)``: where strings to remove start, per text.

    ``starts`` is a list of ``(at, many, mask)``: all ``many`` strings from ``at`` on if
    the mask is -1, else those whose bit is set.
    """
    if not 8 <= gram < length <= gram + 61:
        raise ValueError("length is between gram and gram + 61, gram at least 8")
    spark = docs.sparkSession
    source = docs.select(id_of(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))

    def keys_of(column: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[np.ndarray]]:
        def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for _, texts in arrays.slices(batches, column, SLICE):
                for found in contexts_of(texts, length, gram):
                    yield found.key

        return keys

    most = DEPTH << bits >> 3
    repeated = build(source.select("text"), keys_of("text"), most)
    distinct = (
        source.mapInArrow(
            lambda b: _blocks(b, length, gram, repeated, True), "b1 long, b2 long, id long, block binary"
        )
        .groupBy("b1", "b2")
        .agg(F.min("id").alias("first"), F.first("block").alias("block"))
        .select(F.monotonically_increasing_id().alias("number"), "first", "block", "b1", "b2")
    )
    with shuffles_deleted(spark):
        blocks = stored(distinct, "blocks", "zstd")
    several = build(blocks.select("block"), keys_of("block"), most, many)
    contexts = blocks.select("number", "first", "block").mapInArrow(
        lambda b: _block_contexts(b, length, gram, several), CONTEXTS
    )
    usual, shared = contexts, None
    if several.often is not None:
        # At most one key for every ``many`` contexts, most often none.
        often = F.broadcast(several.often), F.shiftrightunsigned("key", 64 - TOLD) == F.col("told")
        usual = contexts.join(*often, "left_anti")
        shared = stored(contexts.join(*often, "left_semi"), "frequent-contexts")
    masks = (
        usual.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda b: _sorted(b, length), "number long, place int, many int, mask long")
    )
    if shared is not None:
        masks = masks.unionByName(_frequent_masks(shared, length))
    parts = masks.groupBy("number").agg(F.collect_list(F.struct("place", "many", "mask")).alias("parts"))
    sizes = blocks.select("number", "first", "b1", "b2", (F.octet_length("block") - (length - 1)).alias("many"))
    with shuffles_deleted(spark):
        known = stored(sizes.join(parts.hint("merge"), "number", "left").drop("number"), "known", "zstd")
    for done in (blocks, shared):
        if done is not None:
            forget(done)
    places = source.mapInArrow(
        lambda b: _blocks(b, length, gram, repeated, False), "b1 long, b2 long, id long, mark long, at long"
    )
    whole = F.array(F.struct(F.col("at"), F.col("many"), F.lit(-1).cast("long").alias("mask")))
    some = F.transform(
        "parts", lambda p: F.struct((F.col("at") + p["place"]).alias("at"), p["many"].alias("many"), p["mask"].alias("mask"))
    )
    # Both sides are dealt out for the join, so that Spark can split the part of a frequent block.
    return (
        places.join(known.hint("merge"), ["b1", "b2"])
        .where("id > first OR parts IS NOT NULL")
        .select("id", "mark", F.when(F.col("id") > F.col("first"), whole).otherwise(some).alias("s"))
        .groupBy("id", "mark")
        .agg(F.flatten(F.collect_list("s")).alias("starts"))
    )


def spans(sizes: np.ndarray, doc: np.ndarray, at: np.ndarray, many: np.ndarray, mask: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of bytes that the strings of some texts cover, merged: text number, start, end."""
    begin = np.cumsum(sizes) - sizes
    whole = mask == -1
    first = begin[doc] + at
    bits = np.where(whole, 0, mask)
    single = [first[(bits >> k) & 1 == 1] + k for k in range(int(many[~whole].max(initial=0)))]
    start = np.concatenate((first[whole], *single))
    stop = np.concatenate((first[whole] + many[whole] + length - 1, *(x + length for x in single)))
    change = np.zeros(int(sizes.sum()) + 1, dtype=np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, stop, -1)
    covered = np.cumsum(change[:-1], dtype=np.int32) > 0
    edge = np.diff(covered.astype(np.int8), prepend=0)
    heads = np.zeros(len(covered) + 1, dtype=bool)
    heads[begin] = True  # a range ends with its text
    heads = heads[:-1]
    starts = np.flatnonzero((edge == 1) | (covered & heads))
    ends = np.flatnonzero(np.concatenate((covered[:-1] & (~covered[1:] | heads[1:]), covered[-1:]))) + 1
    owner = np.searchsorted(begin, starts, side="right") - 1
    return owner, starts - begin[owner], ends - begin[owner]


def drop_repeated_strings(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    length: int = LENGTH,
    gram: int = GRAM,
    bits: int = BITS,
    many: int = MANY,
) -> DataFrame:
    """The documents with ``n_bytes``, ``spans`` (removed ranges of bytes) and ``kept`` (the other bytes).

    The kept bytes are binary, as a cut may fall inside a character. A name that is
    taken gets an underscore at its end.
    """
    added = [unused(docs, n) for n in ("n_bytes", "spans", "kept")]
    key, mark = unused(docs, "_at_id"), unused(docs, "_at_mark")
    starts = repeated_strings(docs, text, doc_id, length, gram, bits, many).select(
        F.col("id").alias(key), F.col("mark").alias(mark), F.col("starts").alias("_starts")
    )
    at = docs.columns.index(text)
    names = [*docs.columns, *added]
    shape = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    # The texts are all that is large in the last join, so they travel compressed.
    marked = docs.select("*", id_of(doc_id).alias(key), F.xxhash64(text).alias(mark))
    packed_schema = T.StructType([T.StructField(f.name, T.BinaryType() if i == at else f.dataType) for i, f in enumerate(marked.schema)])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [None if t is None else squeeze(t) for t in batch.column(at).cast(pa.binary()).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    joined = marked.mapInArrow(pack, packed_schema).join(starts.hint("merge"), [key, mark], "left").select(*docs.columns, "_starts")

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch, packed in arrays.slices(batches, text, SLICE):
            # A packed text has bytes, be it empty.
            own = [unpack(t) if t else None for t in packed]
            sizes = np.array([len(t or b"") for t in own], dtype=np.int64)
            found = batch.column(batch.num_columns - 1)
            parts = found.flatten()
            doc = np.repeat(np.arange(len(own)), pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))
            fields = [np.asarray(f).astype(np.int64) for f in parts.flatten()]
            # Empty texts have no place of their own, and no strings.
            full = np.flatnonzero(sizes > 0)
            rank = np.zeros(len(own), dtype=np.int64)
            rank[full] = np.arange(len(full))
            owner, start, end = spans(sizes[full], rank[doc], *fields, length) if len(doc) else (doc, doc, doc)
            cuts = np.searchsorted(full[owner], np.arange(len(own) + 1)) if len(doc) else np.zeros(len(own) + 1, dtype=np.int64)
            kept = []
            low, high = start.tolist(), end.tolist()
            for i, t in enumerate(own):
                t, a, b = t or b"", int(cuts[i]), int(cuts[i + 1])
                kept.append(t if a == b else b"".join(t[x:y] for x, y in zip([0, *high[a:b]], [*low[a:b], len(t)])))
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(own, pa.binary()).cast(pa.string())
            ranges = pa.ListArray.from_arrays(
                pa.array(cuts.astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(start), pa.array(end)], names=["start", "end"]),
            )
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes), ranges, pa.array(kept, pa.binary())], names=names
            )

    schema = with_fields(docs.schema, (added[0], T.LongType()), (added[1], shape), (added[2], T.BinaryType()))
    return joined.mapInArrow(apply, schema)
