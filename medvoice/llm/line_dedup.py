"""Line dedup: lines that other documents hold too stay only in the first one.

Two Bloom filters over all line keys tell which were seen once and which twice. Only
lines that the second filter reports leave their task: they are grouped by their whole
key, which confirms the repeat exactly and gives the smallest document id.

A key is the line without white space at its ends, A-Z in lower case. Null and empty
texts are one empty line. Rows without an id count as one document that comes last; rows
that share an id are one document. Nothing else in a row is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medvoice.llm.arrays import LOWER, slices
from medvoice.llm.frames import id_of, rows, unused, with_fields
from medvoice.llm.sketch import build

BLANK = b" \t\n\x0b\x0c\r"
FOLLOWING = bytes(range(0x80, 0xC0))
MIN_CHARS = 10
BITS, HASHES = 27, 3


def keys_of(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """Line numbers of each key of at least ``min_chars`` code points."""
    found: dict[bytes, list[int]] = {}
    for n, line in enumerate(text.split(b"\n")):
        key = line.strip(BLANK).translate(LOWER)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.translate(None, FOLLOWING)) >= min_chars):
            found.setdefault(key, []).append(n)
    return found


def hashes_of(keys: Iterable[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), dtype=np.uint64)


def repeated_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, bits: int = BITS
) -> DataFrame:
    """``(id, mark, lines)``: numbers of the lines to drop in each text with hash ``mark``."""
    source = docs.select(id_of(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, texts in slices(batches, "text"):
            yield np.concatenate([hashes_of(keys_of(t, min_chars)) for t in texts])

    sketch = source.sparkSession.sparkContext.broadcast(
        build(source.select("text"), each, bits, HASHES, shared=True)
    )
    shape = [("id", pa.int64()), ("mark", pa.int64()), ("key", pa.binary()), ("lines", pa.list_(pa.int32()))]

    def suspects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for i, mark, t in zip(ids, marks, texts):
                found = keys_of(t, min_chars)
                if found:
                    again = sketch.value.repeated(hashes_of(found))
                    out += [(i, mark, k, n) for (k, n), yes in zip(found.items(), again) if yes]
            if out:
                yield rows(shape, list(zip(*out)))

    suspect = source.mapInArrow(suspects, "id long, mark long, key binary, lines array<int>")
    first = (
        suspect.groupBy("key")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last")
        .select(F.sha2("key", 256).alias("digest"), "first")
    )
    # By digest both sides are dealt out anew, so Spark can split a frequent line's part.
    return (
        suspect.select("id", "mark", F.sha2("key", 256).alias("digest"), "lines")
        .join(first.hint("merge"), "digest")
        .where("id > first")
        .groupBy("id", "mark")
        .agg(F.flatten(F.collect_list("lines")).alias("lines"))
    )


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_chars: int = MIN_CHARS,
    bits: int = BITS,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """The documents without those lines, and how many lines each had and lost.

    A null text stays null. Columns of the table that bear the name of a count keep
    it; the count is then named with an underscore at its end.
    """
    n_lines, n_dropped = unused(docs, n_lines), unused(docs, n_dropped)
    drops = repeated_lines(docs, text, doc_id, min_chars, bits).select(
        F.col("id").alias("_drop_id"), F.col("mark").alias("_drop_mark"), F.col("lines").alias("_drop_lines")
    )
    joined = docs.join(
        drops, (id_of(doc_id) == F.col("_drop_id")) & (F.xxhash64(text) == F.col("_drop_mark")), "left"
    ).select(*[docs[c] for c in docs.columns], "_drop_lines")
    at = docs.columns.index(text)
    names = [*docs.columns, n_lines, n_dropped]

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, names[at]):
            gone = batch.column(batch.num_columns - 1).to_pylist()
            kept, total, lost = [], [], []
            missing = batch.column(at).is_null().to_pylist()
            for t, g, null in zip(texts, gone, missing):
                lines = t.split(b"\n")
                drop = set(g or ())
                total.append(len(lines))
                lost.append(len(drop))
                kept.append(None if null else b"\n".join(x for n, x in enumerate(lines) if n not in drop) if drop else t)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(lost, pa.int64())], names=names
            )

    return joined.mapInArrow(apply, with_fields(docs.schema, (n_lines, T.LongType()), (n_dropped, T.LongType())))
