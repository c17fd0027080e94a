"""MinHash near-dedup with DartMinHash signatures.

A document is the set of its runs of five words (white space apart, A-Z in lower case; a
text of fewer words is one run). Every run of words throws darts at hashed places of its
own: its region has its weight as width, and the darts' heights form a Poisson process.
A document sees the darts below a height chosen so that about ``k ln k`` of them fall in
all, whatever its length; each dart belongs to one of ``k`` coordinates, the lowest one
of each coordinate is the signature, and a document with an empty coordinate looks twice
as high. Two documents agree in a coordinate with the probability of their weighted
Jaccard similarity. Weights are 1 in the queries here, so that this is the plain one.

Bands of ``rows`` coordinates give buckets. Equal sets are one node before banding. In
each bucket all nodes are first compared with two centres: a big group of near copies
costs two comparisons per member and bucket. Buckets whose nodes are not all of one class
then get other centres, until a round finds no further link (``ROUNDS`` at most). Where
nodes that were no centre are still of several classes, all pairs of them from different
classes are compared, in cells of two pieces of the bucket each; a cell gives links, not
pairs. So every two nodes of a bucket end in one class or have been compared.
A comparison counts the shared runs exactly; ``similarity`` or more is a link, and
linked nodes form a class, named by its smallest document id.

Texts without words (null, empty) are classes of their own. A null id is last; a class
of null ids has a null name. Repeated ids are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medvoice.llm import arrays
from medvoice.llm.arrays import mix
from medvoice.llm.frames import NO_ID, forget, id_of, stored
from medvoice.llm.sketch import build

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 5
ROUNDS = 3
BITS = 27
#: Bytes of sets in a piece of a bucket, and about how many bits of a set's outline one of its elements has.
PIECE, OUTLINE = 1 << 20, 4


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The ascending distinct hashes of each text's runs of ``size`` words."""
    found = arrays.words(texts, lower=True)
    offsets = found.of_doc(len(texts))
    counts = np.diff(offsets)
    _, hashed = arrays.windows(found.hash, offsets, size)
    bounds = np.concatenate(([0], np.cumsum(np.maximum(counts - size + 1, 0))))
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = dict(zip(short.tolist(), arrays.rolling(found.hash, arrays.WORD_BASES[0], offsets[short], offsets[short + 1])))
    return [
        np.array([whole[d]], dtype=np.uint64) if d in whole else np.unique(hashed[bounds[d] : bounds[d + 1]])
        for d in range(len(texts))
    ]


def signatures(sets: list[np.ndarray], k: int, weights: list[np.ndarray] | None = None, more: float = 2.0) -> np.ndarray:
    """DartMinHash signatures, a row of ``k`` values per set; an empty set has zeros.

    ``weights`` are whole numbers from 1; a region of weight w is w strips of width 1.
    """
    if weights is not None:
        sets = [
            np.concatenate([mix(s[w > i] + np.uint64(i)) for i in range(int(w.max(initial=0)))] or [s])
            for s, w in zip(sets, weights)
        ]
    out = np.full((len(sets), k), ~np.uint64(0), dtype=np.uint64)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    todo, height = np.flatnonzero(sizes), k * (np.log(k) + more) / np.maximum(sizes, 1)
    while len(todo):
        own = out[todo]
        own[:] = ~np.uint64(0)
        _throw(np.concatenate([sets[d] for d in todo]), np.repeat(np.arange(len(todo)), sizes[todo]), height[todo], own)
        out[todo] = own
        todo = todo[(own == ~np.uint64(0)).any(axis=1)]
        height[todo] *= 2
    out[sizes == 0] = 0
    return out


def _throw(elements: np.ndarray, owner: np.ndarray, height: np.ndarray, least: np.ndarray) -> None:
    """Put the lowest dart of each coordinate below each owner's height into ``least``."""
    k = least.shape[1]
    flat = least.reshape(-1)
    at = np.zeros(len(elements))
    limit = height[owner]
    step = 0
    while len(elements):
        step += 1
        dart = mix(elements + np.uint64(0x9E3779B97F4A7C15 * step & (1 << 64) - 1))
        at = at - np.log1p(-(dart >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        below = at < limit
        elements, owner, at, limit, dart = elements[below], owner[below], at[below], limit[below], dart[below]
        name = mix(dart)
        cell = owner * k + (name % np.uint64(k)).astype(np.int64)
        packed = (at.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (name >> np.uint64(32))
        np.minimum.at(flat, cell, packed)


def node_of(elements: np.ndarray) -> bytes:
    """Name of a set: 128 bits of its elements in order."""
    whole = np.array([0]), np.array([len(elements)])
    return np.concatenate([arrays.rolling(elements, b, *whole) for b in arrays.WORD_BASES]).tobytes()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _runs(batches: Iterable[pa.RecordBatch], columns: int) -> Iterator[pa.Table]:
    """The runs of rows that are equal in the first columns (whole numbers)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(columns)])
        cuts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
        if held and any(held[-1].column(c)[0] != batch.column(c)[0] for c in range(columns)):
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            held.append(batch.slice(start, end - start))
            if end < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def outlines(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set, in words of 64: one is set if an element falls on it.

    Sets whose rows differ in d bits differ in d elements at least.
    """
    words = 1 << max(0, int(np.median([len(s) for s in sets]) * OUTLINE) // 64).bit_length()
    out = np.zeros((len(sets), words), dtype=np.uint64)
    for row, elements in zip(out, sets):
        place = mix(elements) % np.uint64(64 * words)
        np.bitwise_or.at(row, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


def linked_classes(cell: pa.Table, similarity: float) -> dict[str, np.ndarray]:
    """Links of a cell's nodes, enough to join all of its classes that are linked.

    Nodes of two pieces are compared across; a piece alone, among themselves.
    """
    own, node, label = (cell.column(c).to_numpy() for c in ("own", "node", "class"))
    sets = [np.frombuffer(x, dtype=np.uint64) for x in cell.column("elements").to_pylist()]
    across = cell.column("first")[0] != cell.column("second")[0]
    sizes = np.array([len(s) for s in sets])
    rows = outlines(sets)
    now = np.unique(label, return_inverse=True)[1]
    found = []
    for i in range(len(sets)):
        others = np.flatnonzero(own > own[i]) if across else np.arange(i + 1, len(sets))
        others = others[now[others] != now[i]]
        # At this similarity, two sets differ in so many elements at most.
        most = (1 - similarity) / (1 + similarity) * (sizes[i] + sizes[others]) + 1e-6
        others = others[np.abs(sizes[others] - sizes[i]) <= most]
        most = (1 - similarity) / (1 + similarity) * (sizes[i] + sizes[others]) + 1e-6
        others = others[np.bitwise_count(rows[others] ^ rows[i]).sum(axis=1) <= most]
        for j in others:
            if now[j] != now[i] and jaccard(sets[i], sets[j]) >= similarity:
                found.append((i, j))
                now[now == now[j]] = now[i]
    i, j = np.array(found, dtype=np.int64).reshape(-1, 2).T
    return {"class_a": label[i], "class_b": label[j], "a": node[i], "b": node[j]}


class NearDuplicates:
    """Classes of near duplicates; intermediate tables are below the shared folder."""

    def __init__(
        self,
        docs: DataFrame,
        text: str = "text",
        doc_id: str = "doc_id",
        similarity: float = SIMILARITY,
        shingle: int = SHINGLE,
        bands: int = BANDS,
        rows: int = ROWS,
        bits: int = BITS,
        rounds: int = ROUNDS,
    ):
        self.shingle, self.similarity, self.bits = shingle, similarity, bits
        self.source = docs.select(id_of(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))

        def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in arrays.slices(batches, "text"):
                sets = shingle_sets(texts, shingle)
                signed = signatures(sets, bands * rows)
                keys = np.empty((len(sets), bands), dtype=np.uint64)
                for b in range(bands):
                    ends = np.arange(len(sets) + 1) * rows
                    keys[:, b] = arrays.rolling(
                        np.ascontiguousarray(signed[:, b * rows : (b + 1) * rows]).reshape(-1),
                        arrays.WORD_BASES[0], ends[:-1], ends[1:],
                    ) + np.uint64(b)
                flat = pa.array(mix(keys).reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array([node_of(s) if len(s) else None for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), flat),
                    ],
                    names=["id", "mark", "name", "keys"],
                )

        #: ``(id, mark, name, keys)``: a row per document.
        self.rows = stored(
            self.source.mapInArrow(sign, "id long, mark long, name binary, keys array<long>"), "signed"
        )
        #: ``(node, name, first, keys)``: a row per different set, numbered as it is written.
        self.nodes = stored(
            self.rows.where("name IS NOT NULL")
            .groupBy("name")
            .agg(F.min("id").alias("first"), F.first("keys").alias("keys"))
            .withColumn("node", F.monotonically_increasing_id()),
            "nodes",
        )
        members = self._members()
        sets = self._sets(members)
        self.classes = self._components(self._linked(self._stars(members, 0), sets))
        turn, more = 1, True
        while turn < rounds and more:
            # Buckets that are not one class yet get other centres.
            split = members.join(self._split(members).hint("merge"), "key")
            more = self._joined(self._linked(self._apart(self._stars(split, turn)), sets))
            turn += 1
        self._joined(self._others(members, sets, turn))

    def _classed(self, members: DataFrame) -> DataFrame:
        return members.join(self.classes.hint("merge"), "node", "left").withColumn("class", F.coalesce("class", "node"))

    def _split(self, members: DataFrame) -> DataFrame:
        """``key`` of the buckets of several classes."""
        return (
            self._classed(members)
            .groupBy("key")
            .agg(F.min("class").alias("low"), F.max("class").alias("high"))
            .where("low < high")
            .select("key")
        )

    def _apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs of different classes."""
        name = lambda side: self.classes.select(
            F.col("node").alias(side), F.col("class").alias(f"class_{side}")
        ).hint("merge")
        return (
            pairs.join(name("a"), "a", "left")
            .join(name("b"), "b", "left")
            .where(F.coalesce("class_a", "a") != F.coalesce("class_b", "b"))
            .select(F.coalesce("class_a", "a").alias("class_a"), F.coalesce("class_b", "b").alias("class_b"), "a", "b")
        )

    def _joined(self, links: DataFrame) -> bool:
        """Whether there are links between classes; those they link are one from now on."""
        if not links.limit(1).count():
            return False
        names = self._components(links.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct())
        heads = names.select(F.col("node").alias("class"), F.col("class").alias("head"))
        old = self.classes
        new = old.join(heads.hint("merge"), "class", "left").select("node", F.coalesce("head", "class").alias("class"))
        alone = names.join(old.select("node").hint("merge"), "node", "left_anti").select("node", "class")
        self.classes = stored(new.unionByName(alone), "names")
        return True

    def _members(self) -> DataFrame:
        """``(node, degree, key)`` of the buckets that may hold two nodes, by a sketch of all keys.

        ``degree`` is the number of such buckets of the node.
        """

        def every(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for batch in batches:
                yield batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)

        sketch = self.nodes.sparkSession.sparkContext.broadcast(
            build(self.nodes.select("keys"), every, self.bits, 2)
        )

        def shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                each = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), pa.compute.list_value_length(batch.column(1)))
                yes = sketch.value.repeated(keys.view(np.uint64))
                degree = yes.reshape(batch.num_rows, -1).sum(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {"node": each[yes], "degree": np.repeat(degree, degree), "key": keys[yes]}
                )

        return stored(
            self.nodes.select("node", "keys").mapInArrow(shared, "node long, degree int, key long"), "members"
        )

    def _stars(self, members: DataFrame, turn: int) -> DataFrame:
        """Pairs ``(a, b)`` of each bucket's two centres and its other nodes.

        One centre is the node that shares most buckets, as the original of many
        separately edited copies does; the other is drawn, anew in each bucket and turn.
        Later turns draw both.
        """
        most, other = self._centres(turn)
        centres = (
            members.groupBy("key")
            .agg(
                most.alias("most"),
                other.alias("other"),
                F.min("node").alias("low"),
                F.max("node").alias("high"),
            )
            .where("low < high")
            .select("key", "most", "other", F.xxhash64("key").alias("spread"))
        )
        return (
            members.withColumn("spread", F.xxhash64("key"))
            .join(centres.hint("merge"), ["key", "spread"])
            .select("node", F.explode(F.array("most", "other")).alias("centre"))
            .where("node <> centre")
            .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
            .distinct()
        )

    @staticmethod
    def _centres(turn: int) -> tuple[Column, Column]:
        """A bucket's centres of a turn, as aggregates."""
        drawn = F.xxhash64("node", "key", F.lit(turn))
        rank = F.col("degree") if not turn else F.xxhash64("node", "key", F.lit(-turn))
        return F.max_by("node", F.struct(rank, drawn)), F.min_by("node", drawn)

    def _others(self, members: DataFrame, sets: DataFrame, turns: int) -> DataFrame:
        """Links ``(a, b)`` between the classes of each bucket's nodes that were no centre in any turn.

        A bucket's nodes are dealt out to pieces by hash, and every two pieces meet in a
        cell, so that a bucket of any size fills many tasks with cells of bounded size.
        Buckets with the same such nodes are compared once.
        """
        mixed = self._classed(members.join(self._split(members).hint("merge"), "key"))
        centres = mixed.groupBy("key").agg(
            F.array(*(c for turn in range(turns) for c in self._centres(turn))).alias("centres")
        )
        spread = lambda df: df.withColumn("spread", F.xxhash64("key"))
        left = stored(
            spread(mixed)
            .join(spread(centres).hint("merge"), ["key", "spread"])
            .where(~F.array_contains("centres", F.col("node")))
            .select("key", "node", "class"),
            "left",
        )
        wide = sets.join(left.select("node").distinct().hint("merge"), "node").select(
            "node", F.octet_length("elements").cast("long").alias("bytes")
        )
        groups = (
            left.join(wide.hint("merge"), "node")
            .groupBy("key")
            .agg(
                F.min("class").alias("low"),
                F.max("class").alias("high"),
                F.count("*").alias("n"),
                F.bit_xor(F.xxhash64("node")).alias("one"),
                F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
                F.ceil(F.sum("bytes") / PIECE).alias("pieces"),
            )
            .where("low < high")
            .groupBy("n", "one", "two", "pieces")
            .agg(F.min("key").alias("key"))
            .select("key", "pieces")
        )
        cells = (
            spread(left)
            .join(spread(groups).hint("merge"), ["key", "spread"])
            .withColumn("own", F.pmod(F.xxhash64("node"), "pieces"))
            .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
            .select(
                "key", F.least("own", "with").alias("first"), F.greatest("own", "with").alias("second"), "own", "node", "class"
            )
        )
        similarity = self.similarity

        def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for cell in _runs(batches, 3):
                yield pa.RecordBatch.from_pydict(linked_classes(cell, similarity))

        return stored(
            cells.join(sets.hint("merge"), "node")
            .select("key", "first", "second", "own", "node", "class", "elements")
            .repartition("key", "first", "second")
            .sortWithinPartitions("key", "first", "second")
            .mapInArrow(compare, "class_a long, class_b long, a long, b long"),
            "links",
        )

    def _sets(self, members: DataFrame) -> DataFrame:
        """``(node, elements)``: the whole sets of the members, made again from the texts.

        A filter of fixed size over their names tells which texts to take; those it
        takes wrongly go in the join.
        """
        named = stored(
            self.nodes.select("node", "name").join(members.select("node").distinct().hint("merge"), "node"), "named"
        )
        shingle = self.shingle

        def twice(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for batch in batches:
                names = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint64)[::2]
                yield np.repeat(names, 2)

        filter_ = members.sparkSession.sparkContext.broadcast(build(named.select("name"), twice, self.bits, 2, shared=True))

        def sets_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, texts in arrays.slices(batches, "text"):
                sets = [s for s in shingle_sets(texts, shingle) if len(s)]
                names = [node_of(s) for s in sets]
                if names:
                    yes = filter_.value.repeated(np.frombuffer(b"".join(names), dtype=np.uint64)[::2])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([n for n, y in zip(names, yes) if y], pa.binary()),
                            pa.array([s.tobytes() for s, y in zip(sets, yes) if y], pa.binary()),
                        ],
                        names=["name", "elements"],
                    )

        return stored(
            self.source.mapInArrow(sets_of, "name binary, elements binary")
            .groupBy("name")
            .agg(F.first("elements").alias("elements"))
            .join(named.hint("merge"), "name")
            .select("node", "elements"),
            "sets",
        )

    def _linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs that are similar enough, by their whole sets; further columns of them stay."""
        similarity, names = self.similarity, pairs.columns

        def similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = (
                    [np.frombuffer(x, dtype=np.uint64) for x in batch.column(c).to_pylist()] for c in ("of_a", "of_b")
                )
                yes = pa.array([jaccard(x, y) >= similarity for x, y in zip(a, b)], pa.bool_())
                yield batch.select(names).filter(yes)

        side = lambda name: sets.select(F.col("node").alias(name), F.col("elements").alias(f"of_{name}")).hint("merge")
        joined = pairs.join(side("a"), "a").join(side("b"), "b").select(*names, "of_a", "of_b")
        return stored(joined.mapInArrow(similar, ", ".join(f"{n} long" for n in names)), "links")

    def _components(self, links: DataFrame) -> DataFrame:
        """``(node, class)`` for all linked nodes: the least number that can be reached.

        Each round takes the least name among the neighbours' and then the name of
        that name, so chains shorten by half; it ends when nothing changes.
        """
        both = links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        names = stored(both.groupBy("node").agg(F.least("node", F.min("near")).alias("class")), "names")
        while True:
            near = names.select(F.col("node").alias("near"), F.col("class").alias("near_class"))
            least = (
                both.join(near, "near")
                .groupBy("node")
                .agg(F.min("near_class").alias("near_class"))
                .join(names, "node")
                .select("node", F.col("class").alias("old"), F.least("class", "near_class").alias("class"))
            )
            up = names.select(F.col("node").alias("class"), F.col("class").alias("up"))
            new = stored(
                least.join(up, "class", "left").select(
                    "node", "old", F.least("class", F.coalesce("up", "class")).alias("class")
                ),
                "names",
            )
            forget(names)
            names = new.select("node", "class")
            if not new.where("old <> class").limit(1).count():
                return names

    def documents(self) -> DataFrame:
        """``(id, mark, class_id, class_size)``: the class of every document.

        ``class_id`` is the smallest id in the class, null if that is missing.
        """
        named = self._named()
        size = self.rows.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("n"))
        heads = named.join(size.hint("merge"), "name").groupBy("class").agg(
            F.min("first").alias("class_id"), F.sum("n").alias("class_size")
        )
        of_name = named.join(heads.hint("merge"), "class").select("name", "class_id", "class_size")
        found = self._by_name(of_name).select("id", "mark", "class_id", "class_size")
        alone = self.rows.where("name IS NULL").select(
            "id", "mark", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size")
        )
        return found.unionByName(alone).select(
            F.nullif("id", F.lit(NO_ID)).alias("id"), "mark", F.nullif("class_id", F.lit(NO_ID)).alias("class_id"), "class_size"
        )

    def kept(self) -> DataFrame:
        """``(id, mark, alone)``: the first document of each class, by id and text hash.

        Documents without words are all kept (``alone``). Missing ids are ``NO_ID`` here.
        """
        first = (
            self._by_name(self._named().select("name", "class"))
            .groupBy("class")
            .agg(F.min(F.struct("id", "mark")).alias("least"))
            .select("least.id", "least.mark", F.lit(False).alias("alone"))
        )
        return first.unionByName(
            self.rows.where("name IS NULL").select("id", "mark", F.lit(True).alias("alone")).distinct()
        )

    def _named(self) -> DataFrame:
        return (
            self.nodes.select("node", "name", "first")
            .join(self.classes.hint("merge"), "node", "left")
            .withColumn("class", F.coalesce("class", "node"))
        )

    def _by_name(self, names: DataFrame) -> DataFrame:
        """The rows with what is known of their sets' names.

        The hash as a further key makes both sides be dealt out for the join, so that
        Spark can split the part of a text with very many copies.
        """
        return (
            self.rows.select("id", "mark", "name")
            .withColumn("spread", F.xxhash64("name"))
            .where("name IS NOT NULL")
            .join(names.withColumn("spread", F.xxhash64("name")).hint("merge"), ["name", "spread"])
        )


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents without all but the first of each class, their columns unchanged."""
    kept = NearDuplicates(docs, text, doc_id, **options).kept().select(
        F.col("id").alias("_kept_id"), F.col("mark").alias("_kept_mark"), F.col("alone").alias("_alone")
    )
    copy = F.row_number().over(Window.partitionBy("_kept_id", "_kept_mark").orderBy("_alone"))
    return (
        docs.join(
            kept.hint("merge"),
            (id_of(doc_id) == F.col("_kept_id")) & (F.xxhash64(text) == F.col("_kept_mark")),
        )
        .withColumn("_copy", copy)
        .where("_alone OR _copy = 1")
        .select(*docs.columns)
    )
