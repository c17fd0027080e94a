"""Files whose records span lines, read block by block."""

import csv
import io
import random

import numpy as np
import pytest

from medvoice.schemas import RAW, RAW_TEXT, SCORED
from medvoice.sources import files
from medvoice.sources.split_csv import bits_before, quoted_lines, read_split_csv

HEADER = "\tdrugName\tcondition\treview\trating\tdate\tusefulCount\n"


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few lines, one or more to a task."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def use(size: int, cost: int = 1) -> None:
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], str(cost))

    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def same(spark, path, schema=RAW, delimiter="\t"):
    options = files.csv_options(delimiter)
    want = sorted(map(repr, spark.read.schema(schema).options(**options).csv(path).collect()))
    got = sorted(map(repr, read_split_csv(spark, path, schema, options).collect()))
    assert got == want
    return len(want)


def written(rng, n, ending="\n"):
    """Records with all that quotes allow."""
    out = io.StringIO()
    writer = csv.writer(out, delimiter="\t", lineterminator=ending)
    bits = ["word", "\n", '"', '""', "\t", " ", "é", "\n\n", "\r\n" if ending == "\r\n" else "x", '"\n', '\n"', "|"]
    for i in range(n):
        review = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5, 30, 200])))
        writer.writerow([i, "Dolo", rng.choice(["c", "", 'a "b" c']), "x" + review + "x", i % 10, "May 20, 2012", i])
        if rng.random() < 0.1:
            out.write(ending)  # an empty line between records
        if rng.random() < 0.1:
            out.write(f'{i}\tA\t5" pipe\tstray " quotes " here\t1.0\td\t1{ending}')
    return HEADER.replace("\n", ending) + out.getvalue()


@pytest.mark.parametrize("size", [700, 4000, 1 << 20])
def test_equals_one_task(spark, tmp_path, small_blocks, size):
    rng = random.Random(size)
    folder = tmp_path / "in"
    folder.mkdir()
    for i, ending in enumerate(["\n", "\n", "\r\n"]):
        (folder / f"{i}.tsv").write_text(written(rng, 60, ending), encoding="utf-8", newline="")
    (folder / "long.tsv").write_text(HEADER + '1\tA\tc\t"' + "line\n" * 1500 + '"\t1.0\td\t1\n2\tB\tc\tr\t2.0\td\t2', newline="")
    (folder / "header.tsv").write_text(HEADER, newline="")
    (folder / "empty.tsv").write_text("", newline="")
    (folder / "head2.tsv").write_text('"a\nb"\tdrugName\tx\ty\tz\td\tu\n7\tA\tc\t"say ""hi""\n"\t1.0\td\t1\n', newline="")
    small_blocks(size, 1)
    assert same(spark, str(folder)) > 180
    small_blocks(size, size // 3 + 1)  # several blocks of several files to a task
    same(spark, str(folder))


def test_other_schemas(spark, tmp_path, small_blocks):
    rows = [(i, "A|B", "c", 'say "hi"\nand\tmore | pipes\n' * (i % 4), 9.0, "d", 3, 0.25) for i in range(200)]
    path = str(tmp_path / "scored")
    files.write_scored_csv(spark.createDataFrame(rows, SCORED).coalesce(1), path)
    small_blocks(500)
    assert same(spark, path, SCORED, "|") == 200
    got = files.read_scored_csv(spark, path, split=True)
    assert got.schema == SCORED and got.count() == 200
    raw = str(tmp_path / "raw")
    files.write_reviews_tsv(spark.createDataFrame([r[:7] for r in rows], RAW), raw)
    assert same(spark, raw, RAW_TEXT) == 200
    text = files.read_text_typed(spark, raw, split=True)
    assert sorted(map(tuple, text.collect())) == sorted(map(tuple, files.read_text_typed(spark, raw).collect()))


def test_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "one.tsv").write_text(written(random.Random(1), 400))
    size = (tmp_path / "one.tsv").stat().st_size
    small_blocks(size // 40)
    path = str(tmp_path / "one.tsv")
    assert quoted_lines(spark, path, "\t").rdd.getNumPartitions() >= 40
    assert files.read_reviews_tsv(spark, path).rdd.getNumPartitions() == 1
    split = files.read_reviews_tsv(spark, path, split=True)
    assert split.schema == RAW and split.rdd.getNumPartitions() >= 40
    plan = split._jdf.queryExecution().executedPlan().toString()
    # The records are not shuffled; only the ends of blocks are.
    assert "record" not in "".join(x for x in plan.split("\n") if "Exchange" in x)


def test_bits():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(0, 12))
        out, inside = rng.integers(0, 2, n), rng.integers(0, 2, n)
        for start in (0, 1):
            want = [start]
            for o, i in zip(out, inside):
                want.append(int(i if want[-1] else o))
            assert bits_before(out, inside, start).tolist() == want
