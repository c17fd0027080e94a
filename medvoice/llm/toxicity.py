"""Toxicity: a linear-chain conditional random field over the words of each line.

Labels are given for documents. What they say about words is found first: word parts
(the word, its beginnings and endings) that labelled toxic documents hold far more often
than the others. A word of a toxic document with such a part is a word labelled toxic,
every other word is not, and a field with two states is fitted to runs of words labelled
so: a weight per part, a bias, and the transitions between neighbours.

Forward and backward passes give each word of a text the probability of the toxic state;
chains end at line ends. A document's score comes from the expected number of toxic words
and the largest probability, through a logistic curve fitted to labelled documents; runs
of words of probability 1/2 or more are its offending byte ranges.

The fit sees at most ``sample`` labelled rows of each class and ``runs`` runs of words of
either kind, those of least hash. Scoring covers all words of all texts and uses nothing
but the text. Null and empty texts have no words and get the score of a text without
toxic words. Without a toxic label all scores are the smoothed share of toxic labels.
Several labels of one id count as the largest; null ids and labels are not learnt from.
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

SAMPLE = 20_000
RUNS, RUN = 10_000, 32
HEADS, TAILS = (3, 4, 5, 6), (3, 4, 5)
PARTS = 1 + len(HEADS) + len(TAILS)
#: A part is taken if at least so many toxic documents (and that share of them) hold it,
#: so many times as often as others, and too often for chance among all parts tried.
RATIO, LEAST, SHARE = 4.0, 3, 1e-3
SLICE = 2 << 20


def is_held_out(doc_id: str, folds: int = 5, fold: int = 0) -> Column:
    """Whether the remainder of the id's checksum is ``fold``; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def parts_of(texts: list[bytes]) -> tuple[arrays.Words, np.ndarray, np.ndarray]:
    """Words, their number among the different ones, and the parts of those (0: no such part)."""
    found = arrays.words(texts, arrays.ALNUM, lower=True)
    _, first, number = np.unique(found.hash, return_index=True, return_inverse=True)
    joined, at, spell = bytearray(), 0, []
    for i in first:
        d = found.doc[i]
        word = texts[d][found.start[i] : found.end[i]]
        spell.append(len(joined))
        joined += word
    data = np.frombuffer(bytes(joined).translate(arrays.LOWER), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    start = np.array(spell, dtype=np.int64)
    length = (found.end - found.start)[first]
    parts = np.zeros((len(first), PARTS), dtype=np.uint64)
    parts[:, 0] = arrays.mix(found.hash[first])
    for column, n in enumerate((*HEADS, *(-n for n in TAILS)), 1):
        long = length >= abs(n)
        low = start[long] if n > 0 else (start + length)[long] + n
        parts[long, column] = arrays.mix(
            arrays.rolling(data, arrays.BYTE_BASES[1], low, low + abs(n)) + np.uint64(column)
        )
    return found, number, parts


@dataclass
class Field:
    """Known parts in ascending order, their weights, bias, transitions, curve of scores."""

    parts: np.ndarray
    weights: np.ndarray
    bias: float
    change: np.ndarray
    curve: tuple[float, float, float]

    def emissions(self, parts: np.ndarray) -> np.ndarray:
        """Evidence for the toxic state of each word with these parts."""
        if not len(self.parts):
            return np.full(len(parts), self.bias)
        at = numbers(self.parts, parts)
        return self.bias + np.where(at >= 0, self.weights[at], 0.0).sum(axis=1)


def numbers(known: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Place of each part among the known ones, -1 for others."""
    if not len(known):
        return np.full(parts.shape, -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, parts), len(known) - 1)
    return np.where(known[at] == parts, at, -1)


def chains(texts: list[bytes], found: arrays.Words) -> np.ndarray:
    """First words of the chains: a new one begins with each text and each line."""
    if not len(found.doc):
        return np.zeros(0, dtype=np.int64)
    line = np.zeros(len(found.doc), dtype=np.int64)
    offsets = found.of_doc(len(texts))
    for d, text in enumerate(texts):
        ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10)
        own = slice(offsets[d], offsets[d + 1])
        line[own] = np.searchsorted(ends, found.start[own])
    new = (found.doc[1:] != found.doc[:-1]) | (line[1:] != line[:-1])
    return np.flatnonzero(np.concatenate(([True], new)))


def messages(evidence: np.ndarray, first: np.ndarray, length: np.ndarray, change: np.ndarray) -> np.ndarray:
    """What the words before each word say about its state, as log odds.

    All chains take a step at once, the longest ones last.
    """
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    e = np.exp(change)
    out = np.zeros(len(evidence))
    active = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), side="right")
    for step in range(1, len(active)):
        at = first[: active[step]] + step
        odds = np.exp(np.clip(out[at - 1] + evidence[at - 1], -500, 500))
        out[at] = np.log((e[0, 1] + e[1, 1] * odds) / (e[0, 0] + e[1, 0] * odds))
    return out


def marginals(evidence: np.ndarray, first: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Probability of the toxic state of each word: forward and backward messages."""
    n = len(evidence)
    length = np.diff(np.concatenate((first, [n])))
    forward = messages(evidence, first, length, change)
    backward = messages(evidence[::-1], (n - first - length), length, change.T)[::-1]
    return 1 / (1 + np.exp(-np.clip(evidence + forward + backward, -500, 500)))


def fit_field(
    cell: np.ndarray, part: np.ndarray, toxic: np.ndarray, real: np.ndarray, known: int, rounds: int = 80
) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias, transitions from runs of words.

    Word ``cell`` (run times steps plus step) has the known part ``part``; ``toxic`` has
    the states, ``real`` is false beyond the end of a run. Penalised maximum likelihood
    by Adam on the whole sample.
    """
    runs, steps = toxic.shape
    theta = np.zeros(known + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = max(1, real.sum())
    pair = real[:, 1:]
    for t in range(1, rounds + 1):
        w, bias, change = theta[:known], theta[known], theta[known + 1 :].reshape(2, 2)
        e = bias + np.bincount(cell, weights=w[part], minlength=runs * steps).reshape(runs, steps)
        alpha = np.zeros((runs, steps, 2))
        beta = np.zeros((runs, steps, 2))
        alpha[:, 0, 1] = e[:, 0]
        for s in range(1, steps):
            into = np.logaddexp(alpha[:, s - 1, :1] + change[0], alpha[:, s - 1, 1:] + change[1])
            into[:, 1] += e[:, s]
            alpha[:, s] = np.where(real[:, s, None], into, alpha[:, s - 1])
        for s in range(steps - 2, -1, -1):
            back = beta[:, s + 1].copy()
            back[:, 1] += e[:, s + 1]
            from_next = np.logaddexp(change[:, 0] + back[:, :1], change[:, 1] + back[:, 1:])
            beta[:, s] = np.where(real[:, s + 1, None], from_next, 0.0)
        norm = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])[:, None]
        p1 = np.where(real, np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - norm, 0)), 0)
        off = np.where(real, p1 - toxic, 0.0)
        grad = np.zeros_like(theta)
        grad[:known] = np.bincount(part, weights=off.reshape(-1)[cell], minlength=known)
        grad[known] = off.sum()
        for a in (0, 1):
            for b in (0, 1):
                joint = alpha[:, :-1, a] + change[a, b] + b * e[:, 1:] + beta[:, 1:, b] - norm
                seen = (toxic[:, :-1] == a) & (toxic[:, 1:] == b)
                grad[known + 1 + 2 * a + b] = np.where(pair, np.exp(np.minimum(joint, 0)) - seen, 0.0).sum()
        grad = grad / total + 1e-6 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return theta[:known], float(theta[known]), theta[known + 1 :].reshape(2, 2)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on two values by Newton's method."""
    design = np.column_stack((np.ones(len(x)), x))
    theta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - 1e-3 * theta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(3)
        step = np.linalg.solve(bend, slope)
        theta = theta + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(t) for t in theta)


def surprise(a: np.ndarray, c: np.ndarray, n_a: int, n_c: int) -> np.ndarray:
    """Likelihood ratio statistic of a part held by a of n_a and c of n_c documents."""
    share = (a + c) / (n_a + n_c)
    out = np.zeros(len(a))
    for seen, expected in ((a, n_a * share), (c, n_c * share), (n_a - a, n_a * (1 - share)), (n_c - c, n_c * (1 - share))):
        out += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, sample: int) -> DataFrame:
    """``(text, toxic, weight)`` of at most ``sample`` rows a class, by least hash of the id."""
    spark = docs.sparkSession
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("_id"))
        .agg((F.max(label) > 0).cast("int").alias("_toxic"))
    )
    known = known.where(~is_held_out("_id"))
    counts = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    rows = []
    for value in (0, 1):
        some = known.where(F.col("_toxic") == value).orderBy(F.xxhash64("_id"), "_id").limit(sample).collect()
        rows += [(r["_id"], value, counts[value] / len(some)) for r in some]
    kind = docs.schema[doc_id].dataType.simpleString()
    # At most 2 * sample rows: a bounded table, and no text is shuffled.
    chosen = F.broadcast(spark.createDataFrame(rows, f"_id {kind}, _toxic int, _weight double"))
    return docs.join(chosen, F.col(doc_id) == F.col("_id")).select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col("_toxic").alias("toxic"), F.col("_weight").alias("weight")
    )


def _count_parts(batches: Iterable[pa.RecordBatch], known: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """In how many documents of the batches each part is: of all parts or of the known ones."""
    for _, texts in arrays.slices(batches, "text"):
        found, number, parts = parts_of(texts)
        if known is not None:
            parts = numbers(known, parts)
        names = []
        offsets = found.of_doc(len(texts))
        for d in range(len(texts)):
            own = np.unique(parts[np.unique(number[offsets[d] : offsets[d + 1]])])
            names.append(own[own > 0] if known is None else own[own >= 0])
        values, n = np.unique(np.concatenate(names), return_counts=True)
        yield pa.RecordBatch.from_pydict({"part": values.view(np.int64), "n": n.astype(np.int64)})


def _pairs(numbered: np.ndarray) -> bytes:
    """Word and part of everything known in a run."""
    word, column = np.nonzero(numbered >= 0)
    return np.column_stack((word, numbered[word, column])).astype(np.int32).tobytes()


def _runs(batches: Iterable[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs of words with the states that the labels give them."""
    for batch, texts in arrays.slices(batches, "text"):
        found, number, parts = parts_of(texts)
        if not len(number):
            continue
        numbered = numbers(known, parts)[number]
        document = np.array(batch.column(batch.schema.get_field_index("toxic")).to_pylist())[found.doc]
        toxic = (numbered >= 0).any(axis=1) & (document == 1)
        first = chains(texts, found)
        length = np.diff(np.concatenate((first, [len(number)])))
        pieces = -(-length // RUN)
        start = np.repeat(first, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        end = np.minimum(start + RUN, np.repeat(first + length, pieces))
        rows = [(s, e) for s, e in zip(start, end)]
        yield pa.RecordBatch.from_pydict(
            {
                "any": pa.array([bool(toxic[s:e].any()) for s, e in rows]),
                "parts": pa.array([_pairs(numbered[s:e]) for s, e in rows], pa.binary()),
                "states": pa.array([toxic[s:e].tobytes() for s, e in rows], pa.binary()),
            }
        )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    sample: int = SAMPLE,
    runs: int = RUNS,
) -> Field:
    """Fit the field and the curve to a bounded sample of labelled rows."""
    rows = stored(labelled_sample(docs, labels, text, doc_id, label, sample), "labelled")
    by_class = {r["toxic"]: (r["n"], r["w"]) for r in rows.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    (n_toxic, w_toxic), (n_clean, w_clean) = by_class.get(1, (0, 0.0)), by_class.get(0, (0, 0.0))
    share = (w_toxic + 0.5) / (w_toxic + w_clean + 2)
    none = np.zeros(0, dtype=np.uint64)
    if not n_toxic or not n_clean:
        return Field(none, np.zeros(0), -30.0, np.zeros((2, 2)), (float(np.log(share / (1 - share))), 0.0, 0.0))
    toxic_rows, clean_rows = (rows.where(F.col("toxic") == v).select("text") for v in (1, 0))
    common = (
        toxic_rows.mapInArrow(lambda b: _count_parts(b, None), "part long, n long")
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(LEAST, SHARE * n_toxic))
    ).toArrow()
    values = common.column("part").to_numpy().view(np.uint64)
    order = np.argsort(values)
    known, of_toxic = values[order], common.column("n").to_numpy()[order]
    of_clean = np.zeros(len(known))
    counted = (
        clean_rows.mapInArrow(lambda b: _count_parts(b, known), "part long, n long")
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
    ).toArrow()
    of_clean[counted.column("part").to_numpy()] = counted.column("n").to_numpy()
    ratio = ((of_toxic + 0.5) / (n_toxic + 1)) / ((of_clean + 0.5) / (n_clean + 1))
    known = known[(ratio >= RATIO) & (surprise(of_toxic, of_clean, n_toxic, n_clean) >= 2 * np.log(len(known) + 1) - 2)]
    if not len(known):
        return Field(none, np.zeros(0), -30.0, np.zeros((2, 2)), (float(np.log(share / (1 - share))), 0.0, 0.0))
    made = stored(rows.mapInArrow(lambda b: _runs(b, known), "any boolean, parts binary, states binary"), "runs")
    chosen = [
        r
        for kind in (True, False)
        for r in made.where(F.col("any") == kind).orderBy(F.xxhash64("parts", "states"), "parts").limit(runs).collect()
    ]
    states = np.zeros((len(chosen), RUN), dtype=np.int8)
    real = np.zeros((len(chosen), RUN), dtype=bool)
    cells, parts = [], []
    for i, r in enumerate(chosen):
        own = np.frombuffer(r["states"], dtype=bool)
        states[i, : len(own)], real[i, : len(own)] = own, True
        pairs = np.frombuffer(r["parts"], dtype=np.int32).reshape(-1, 2)
        cells.append(i * RUN + pairs[:, 0].astype(np.int64))
        parts.append(pairs[:, 1])
    del chosen
    weights, bias, change = fit_field(np.concatenate(cells), np.concatenate(parts), states, real, len(known))
    field = Field(known, weights, bias, change, (0.0, 0.0, 0.0))
    seen = tagged(rows.select("text", "toxic", "weight"), field, spans=False).select(
        "toxic", "weight", *_inputs("expected", "top")
    ).toArrow()
    x = np.column_stack((seen.column("x1").to_numpy(), seen.column("x2").to_numpy()))
    forget(made)
    forget(rows)
    field.curve = fit_curve(x, seen.column("toxic").to_numpy().astype(float), seen.column("weight").to_numpy())
    return field


def _inputs(expected: str, top: str) -> list[Column]:
    """What the curve of scores is drawn over."""
    return [
        F.log(F.col(expected) + 0.01).alias("x1"),
        F.log((F.col(top) + 1e-4) / (1.0001 - F.col(top))).alias("x2"),
    ]


def tagged(docs: DataFrame, field: Field, text: str = "text", spans: bool = True) -> DataFrame:
    """The documents with ``expected`` (toxic words), ``top`` (largest probability) and
    ``toxic_spans`` (byte ranges); a name that is taken gets an underscore at its end.
    """
    added = [unused(docs, n) for n in ("expected", "top", "toxic_spans")]
    shape = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    model = docs.sparkSession.sparkContext.broadcast(field)
    names = [*docs.columns, *added]

    def tag(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = model.value
        for batch, texts in arrays.slices(batches, text, SLICE):
            found, number, parts = parts_of(texts)
            first = chains(texts, found)
            p = marginals(f.emissions(parts)[number], first, f.change)
            begins = np.zeros(len(p), dtype=bool)
            begins[first] = True
            n = len(texts)
            top = np.zeros(n)
            np.maximum.at(top, found.doc, p)
            ranges: list[list[dict]] = [[] for _ in texts]
            if spans:
                hot = np.flatnonzero(p >= 0.5)
                for i, w in enumerate(hot):
                    d = found.doc[w]
                    if i and hot[i - 1] == w - 1 and not begins[w]:
                        ranges[d][-1]["end"] = int(found.end[w])
                    else:
                        ranges[d].append({"start": int(found.start[w]), "end": int(found.end[w])})
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(batch.num_columns)),
                    pa.array(np.bincount(found.doc, weights=p, minlength=n).astype(float)),
                    pa.array(top),
                    pa.array(ranges, span_type),
                ],
                names=names,
            )

    schema = with_fields(docs.schema, (added[0], T.DoubleType()), (added[1], T.DoubleType()), (added[2], shape))
    return docs.mapInArrow(tag, schema)


def score(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """:func:`tagged` documents with ``score`` and ``predicted`` (1 from a score of 1/2)."""
    out = tagged(docs, field, text)
    expected, top = out.columns[-3], out.columns[-2]
    x1, x2 = _inputs(expected, top)
    a, b, c = field.curve
    name, said = unused(out, "score"), unused(out, "predicted")
    # Not rounded to 1 or 0, so that the order of very sure documents is kept.
    sure = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * x1 + F.lit(c) * x2)))
    return out.withColumn(name, sure).withColumn(said, (F.col(name) >= 0.5).cast("int"))
