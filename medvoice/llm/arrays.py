"""Words and windows of whole texts as numpy arrays, for the work inside a task.

Texts are handled as UTF-8 bytes. All separators are ASCII, so a byte-wise cut never
splits a character. Work is done in pieces of bounded size whatever the lengths of the
texts: many short texts share a piece, and a long text is cut into several at a
separator (a single word longer than a piece gets a piece of its own).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes handled at once, for which arrays of 60 times as much are made; and bytes of text
# taken at once, with about 50 times as much in arrays. Both bound what a worker needs.
PIECE = 1 << 19
SLICE = 2 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of a word by ``[^\x20\x09-\x0D]+``.
VISIBLE = ~WHITE
#: Bytes of a word by ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z, all of non-ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Words of more bytes are named by xxh3: a polynomial modulo 2**64 gives some pairs of long
# strings one value whatever its base (the shortest known have 1,024 bytes).
LONG = 64

# Odd multipliers of the two polynomial hashes over bytes and of the two over words.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
WORD_BASES = (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
_MASK = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection, so it adds no collisions)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below n, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 2 * len(have[0]) if have else 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b & _MASK, dtype=np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        have = _powers[base] = (out[0], out[1])
    return have


def rolling(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each ``values[start:end]``, modulo 2**64."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of some texts: text number, first byte and end within that text, hash, and another one if asked for."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    other: np.ndarray | None = None

    def of_doc(self, n: int) -> np.ndarray:
        """Offsets of each text's words: text d has words offsets[d] to offsets[d + 1]."""
        return np.searchsorted(self.doc, np.arange(n + 1))


def _pieces(texts: list[bytes], table: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Parts (text number, from, to) of about one piece together."""
    parts, size = [], 0
    for d, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE)
            if end < len(text):
                low = end
                while low > at and table[text[low]]:
                    low -= 1
                if low == at:
                    while end < len(text) and table[text[end]]:
                        end += 1
                else:
                    end = low
            if parts and size + end - at > PIECE:
                yield parts
                parts, size = [], 0
            parts.append((d, at, end))
            size += end - at + 1
            at = end
    if parts:
        yield parts


def word_hashes(data: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``."""
    hashed = rolling(data.astype(np.uint64) + np.uint64(1), base, start, end)
    for i in np.flatnonzero(end - start > LONG):
        hashed[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes(), seed=base & _MASK)
    return hashed


def words(
    texts: list[bytes],
    table: np.ndarray = VISIBLE,
    lower: bool = False,
    bases: tuple[int, ...] = BYTE_BASES[:1],
) -> Words:
    """All words of the texts, in order; a word is a longest run of bytes in ``table``.

    Two ``bases`` give a second, independent hash of each word.
    """
    if lower:
        texts = [t.translate(LOWER) for t in texts]
    out: list[tuple[np.ndarray, ...]] = []
    for parts in _pieces(texts, table):
        data = np.frombuffer(b"\n".join(texts[d][a:b] for d, a, b in parts), dtype=np.uint8)
        edge = np.diff(np.concatenate(([False], table[data], [False])).view(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hashed = [word_hashes(data, base, start, end) for base in bases]
        number, at, to = (np.array(x, dtype=np.int64) for x in zip(*parts))
        first = np.concatenate(([0], np.cumsum(to - at + 1)[:-1]))
        part = np.searchsorted(first, start, side="right") - 1
        shift = (at - first)[part]
        out.append((number[part], start + shift, end + shift, *hashed))
    if not out:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none, *(np.zeros(0, dtype=np.uint64) for _ in bases))
    return Words(*(np.concatenate(x) for x in zip(*out)))


def windows(hashes: np.ndarray, offsets: np.ndarray, width: int, base: int = WORD_BASES[0]) -> tuple[np.ndarray, np.ndarray]:
    """Starts (as word numbers) and hashes of all runs of ``width`` words inside one text."""
    counts = np.diff(offsets)
    valid = np.maximum(counts - width + 1, 0)
    start = np.repeat(offsets[:-1] - np.concatenate(([0], np.cumsum(valid)[:-1])), valid) + np.arange(valid.sum())
    return start, rolling(hashes, base, start, start + width)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Row ranges of the batches with about ``most`` bytes of text (at least one row) each."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(sizes):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] - sizes[at] + most, side="right")))
            # Only the texts of this slice are copied, however large the batch is.
            yield batch.slice(at, end - at), texts_of(values.slice(at, end - at))
            at = end


def anchors(grams: np.ndarray, offsets: np.ndarray, reach: int) -> np.ndarray:
    """For each gram the first of the next ``reach`` grams whose hash is least.

    ``offsets`` bounds the grams of each text; the search ends there. What is chosen
    depends on the content of those grams alone, so equal runs of ``reach`` grams
    choose the same place.
    """
    n = len(grams)
    if not n:
        return np.zeros(0, dtype=np.int64)
    place = np.uint64((1 << 27) - 1)
    if n > int(place):
        raise ValueError("call it on fewer grams at a time")
    least = (grams & ~place) | np.arange(n, dtype=np.uint64)
    last = np.repeat(offsets[1:], np.diff(offsets)) - 1
    here, have = np.arange(n), 1
    while have < reach:
        step = min(have, reach - have)
        least = np.minimum(least, least[np.minimum(here + step, last)])
        have += step
    return (least & place).astype(np.int64)
