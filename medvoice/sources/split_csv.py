"""Delimited files whose records span lines, read by many tasks per file.

Spark reads such a file in one task, since a line break may lie inside quotes. Here a
file is read as lines, block by block. Whether a block starts inside quotes depends on all
blocks before it, but only through one bit:

1. Each line maps the bit before it to the bit after it. A block's lines make one such map
   (there are four), and the ends of the block that may belong to records of other blocks.
   That is a row per block.
2. Along the blocks of a file the maps are applied one after the other by windows over
   those rows, which tells every block its bit.
3. With it each block's records are put together where they are read, without a shuffle.
   Records that cross blocks are put together from the kept ends, which are grouped by
   record.

Records are parsed by Spark's own CSV expression with the options of the one-task reader,
so rows are the same. A quote opens a field only where a field begins, so a stray one in
plain text does no harm. Lines end with a line feed, or all lines of a file with a carriage
return and a line feed, which then stand for a line feed inside quotes too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medvoice.workspace import materialize

QUOTE = '"'
BLOCK = ["file", "block"]
ENDS = (
    "file string, block long, after_out int, after_in int, "
    "head string, tail_out string, tail_in string, only_out boolean, returns boolean"
)


def _after(parts: Column, start: int, delimiter: str) -> Column:
    """The bit after a line (1: inside quotes) if it is ``start`` before; ``parts`` lie between its quotes."""

    def step(state: Column, text: Column) -> Column:
        bare = F.rtrim(text)
        opens = (
            (state["first"] & (bare == ""))
            | F.endswith(bare, F.lit(delimiter))
            | (state["closed"] & (text == ""))  # a doubled quote goes on
        )
        return F.struct(
            (~state["inside"] & opens).alias("inside"),
            state["inside"].alias("closed"),
            F.lit(False).alias("first"),
        )

    begin = F.struct(F.lit(start == 1).alias("inside"), F.lit(False).alias("closed"), F.lit(True).alias("first"))
    return F.aggregate(F.slice(parts, 1, F.size(parts) - 1), begin, step, lambda s: s["inside"].cast("int"))


def quoted_lines(spark: SparkSession, path: str | Sequence[str], delimiter: str) -> DataFrame:
    """``(file, block, line, after_out, after_in)`` in the order of the file within a block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    parts = F.split("value", QUOTE)
    plain = ~F.contains("value", F.lit(QUOTE))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
        F.when(plain, 0).otherwise(_after(parts, 0, delimiter)).alias("after_out"),
        F.when(plain, 1).otherwise(_after(parts, 1, delimiter)).alias("after_in"),
    )


def bits_before(out: np.ndarray, inside: np.ndarray, start: int) -> np.ndarray:
    """The bit before each line, and after the last one, from the lines' maps."""
    fixed, turns = out == inside, (out == 1) & (inside == 0)
    turned = np.concatenate(([0], np.cumsum(turns)))
    last = np.maximum.accumulate(np.concatenate(([0], np.where(fixed, np.arange(1, len(out) + 1), 0))))
    base = np.where(last > 0, np.concatenate(([0], out))[last], start)
    return (base + turned - turned[last]) % 2


def _by_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch, bool]]:
    """Runs of rows of one block, and whether the block is a new one; a task may read several."""
    last = None
    for batch in batches:
        file, block = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        names = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((np.diff(block) != 0) | (np.diff(names) != 0)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(block)]):
            if b > a:
                key = (file[a].as_py(), int(block[a]))
                yield key, batch.slice(a, b - a), key != last
                last = key


class _Walk:
    """Records of a block for one value of the bit before it."""

    def __init__(self, bit: int):
        self.bit, self.whole = bit, bit == 1
        self.head: list[str] = []
        self.open: list[str] = []
        self.records = 0

    def add(self, lines: list[str], out: np.ndarray, inside: np.ndarray) -> list[str]:
        """Take more lines and return the records that are complete with them."""
        bits = bits_before(out, inside, self.bit)
        starts = np.flatnonzero(bits[:-1] == 0)
        self.bit = int(bits[-1])
        at = int(starts[0]) if len(starts) else len(lines)
        (self.head if self.whole else self.open).extend(lines[:at])
        if not len(starts):
            return []
        done = ["\n".join(self.open)] if self.open and not self.whole else []
        self.whole = False
        ends = np.append(starts[1:], len(lines))
        done += [lines[a] if b == a + 1 else "\n".join(lines[a:b]) for a, b in zip(starts, ends)]
        # The last one is complete only with the next record's start, or the block's end.
        self.open = lines[int(starts[-1]) :]
        done.pop()
        self.records += len(done)
        return done

    def end(self) -> tuple[list[str], str | None]:
        """The last record if it is complete, and else what there is of it."""
        text = "\n".join(self.open) if self.open else None
        self.open = []
        if text is None or self.bit == 1:
            return [], text
        self.records += 1
        return [text], None


def _block_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block: its map, and its first and last lines that other blocks may need."""
    walks: list[_Walk] = []
    key, returns = None, False

    def row() -> pa.RecordBatch:
        out, inside = walks
        (_, tail_out), (_, tail_in) = out.end(), inside.end()
        values = [*key, out.bit, inside.bit, "\n".join(inside.head), tail_out, tail_in, out.records == 0, returns]
        types = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
        names = [c.split()[0] for c in ENDS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    for here, batch, new in _by_block(batches):
        if new:
            if key is not None:
                yield row()
            key, walks = here, [_Walk(0), _Walk(1)]
            returns = here[1] == 0 and batch.column(2)[0].as_py().endswith("\r")
        lines = batch.column(2).to_pylist()
        for walk in walks:
            walk.add(lines, *(batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4)))
    if key is not None:
        yield row()


def _records(batches: Iterable[pa.RecordBatch], header: bool) -> Iterator[pa.RecordBatch]:
    """Records that lie in one block, but for the header; rows come with their block's bit."""
    walk, skip, returns = _Walk(0), False, False

    def out(done: list[str]) -> Iterator[pa.RecordBatch]:
        nonlocal skip
        done = [d.replace("\r\n", "\n") if returns else d for d in done if d not in ("", "\r")]
        if skip and done:
            skip, done = False, done[1:]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["record"])

    for (_, block), batch, new in _by_block(batches):
        if new:
            yield from out(walk.end()[0])
            walk, skip = _Walk(batch.column(5)[0].as_py()), header and block == 0
            returns = batch.column(6)[0].as_py()
        yield from out(walk.add(batch.column(2).to_pylist(), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))))
    yield from out(walk.end()[0])


def started(ends: DataFrame) -> DataFrame:
    """The blocks with ``bit``, 1 if they start inside quotes, and whether their file's lines end
    with carriage returns. A row per block, a window per file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block")
    fixed = F.col("after_out") == F.col("after_in")
    turn = ((F.col("after_out") == 1) & (F.col("after_in") == 0)).cast("int")
    turned = ends.withColumn("turned", F.sum(turn).over(upto))
    base = F.coalesce(F.last(F.when(fixed, F.col("after_out")), ignorenulls=True).over(before), F.lit(0))
    since = F.coalesce(F.last("turned").over(before), F.lit(0)) - F.coalesce(
        F.last(F.when(fixed, F.col("turned")), ignorenulls=True).over(before), F.lit(0)
    )
    every = Window.partitionBy("file")
    return turned.select(
        *[c for c in ends.columns if c != "returns"],
        ((base + since) % 2).cast("int").alias("bit"),
        F.max("returns").over(every).alias("returns"),
    )


def crossing(blocks: DataFrame, header: bool) -> DataFrame:
    """Records that lie in several blocks, from the ends of those blocks."""
    inside = F.col("bit") == 1
    ends = blocks.select(
        *BLOCK,
        "returns",
        F.inline(F.array(
            F.struct(F.lit(0).alias("place"), F.when(inside, F.col("head")).alias("text"), F.lit(False).alias("only")),
            F.struct(
                F.lit(1).alias("place"),
                F.when(inside, F.col("tail_in")).otherwise(F.col("tail_out")).alias("text"),
                (F.col("only_out") & (F.col("block") == 0)).alias("only"),
            ),
        )),
    ).where("text IS NOT NULL")
    along = Window.partitionBy("file").orderBy("block", "place")
    numbered = ends.withColumn("number", F.sum("place").over(along))
    records = numbered.groupBy("file", "number").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct(*BLOCK[1:], "place", "text"))), lambda e: e["text"]), "\n"
        ).alias("record"),
        F.max("only").alias("only"),
        F.max("returns").alias("returns"),
    )
    kept = records.where(~F.col("only")) if header else records
    return kept.select(F.when(F.col("returns"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record")).alias("record"))


def read_split_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    options: Mapping[str, str],
) -> DataFrame:
    """The rows that Spark's reader gives with these options, from as many tasks as the files have blocks.

    The files are read twice: once for a row per block, written to the shared folder, and
    once for the records. What is broadcast is a row for each block that starts inside
    quotes or has carriage returns, a millionth of the text.
    """
    delimiter, header = options["sep"], options.get("header") == "true"
    lines = quoted_lines(spark, path, delimiter)
    # What lies at the ends of blocks is needed twice.
    blocks = started(materialize(lines.mapInArrow(_block_ends, ENDS), "blocks"))
    special = F.broadcast(blocks.where("bit = 1 OR returns").select(*BLOCK, "bit", "returns"))
    marked = lines.join(special, BLOCK, "left").select(
        *BLOCK, "line", "after_out", "after_in",
        F.coalesce("bit", F.lit(0)).alias("bit"), F.coalesce("returns", F.lit(False)).alias("returns"),
    )
    records = marked.mapInArrow(
        lambda batches: _records(batches, header), "record string"
    )
    every = records.unionByName(crossing(blocks, header))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.regexp_replace("record", "\r$", ""), columns, dict(options))
    return every.select(parsed.alias("row")).select("row.*")
