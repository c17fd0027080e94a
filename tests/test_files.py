import pytest
from pyspark.errors import PySparkException

from medvoice.schemas import LANDED, RAW, SCORED, with_int_ids
from medvoice.sources import files

# Empty first header cell, doubled quotes and a line break, padding, an entity,
# markup, an empty condition, bad numbers.
RAW_TSV = (
    "\tdrugName\tcondition\treview\trating\tdate\tusefulCount\n"
    '1\tDolo\tFever\t"""It has no\nside effect"", they said"\t9.0\t"May 20, 2012"\t27\n'
    "2\t  Padded  \tPain\tCan&#039;t sleep\t8.0\tApril 2, 2010\t192\n"
    "3\tDolo\t3</span> users found this comment helpful.\tok\t5.0\tMay 1, 2011\t1\n"
    "4\tDolo\t\tfine\t3.0\tMay 1, 2011\t2\n"
    "x\tDolo\tFever\tbad numbers\t1.0\tMay 1, 2011\tmany\n"
)


@pytest.fixture
def raw_path(tmp_path):
    path = tmp_path / "raw.tsv"
    path.write_text(RAW_TSV, encoding="utf-8")
    return str(path)


def test_raw_tsv(spark, raw_path):
    df = files.read_reviews_tsv(spark, raw_path)
    assert df.schema == RAW
    rows = df.collect()
    assert len(rows) == 5
    assert rows[0].review == '"It has no\nside effect", they said'
    assert rows[0].date == "May 20, 2012"
    assert rows[1].drugName == "Padded"
    assert rows[1].review == "Can&#039;t sleep"
    assert rows[3].condition is None
    # A bad number is NULL; its row stays.
    assert rows[4].UniqueID is None and rows[4].usefulCount is None
    assert rows[4].review == "bad numbers"


def test_text_typed_read_is_strict(spark, raw_path, tmp_path):
    with pytest.raises(PySparkException):
        files.read_text_typed(spark, raw_path).collect()
    good = tmp_path / "good.tsv"
    good.write_text("".join(RAW_TSV.splitlines(keepends=True)[:-1]), encoding="utf-8")
    rows = files.read_text_typed(spark, str(good)).collect()
    assert [r.usefulCount for r in rows] == [27.0, 192.0, 1.0, 2.0]
    assert dict(files.read_text_typed(spark, str(good)).dtypes)["UniqueID"] == "double"


def test_scored_csv_round_trip(spark, tmp_path):
    rows = [
        (1, "A|B", "c", 'say "hi"\nand\tmore | pipes', 9.0, "May 20, 2012", 3, 0.25),
        (2, "A", "c", "  blanks stay  ", 1.5, "d", 0, -1.0),
        (3, "A", "c", "back\\slash", None, "d", None, 0.0),
        (4, "A", "c", '""', 1.0, "d", 1, 0.0),
    ]
    path = str(tmp_path / "scored")
    files.write_scored_csv(spark.createDataFrame(rows, SCORED), path, 2)
    got = {tuple(r) for r in files.read_scored_csv(spark, path).collect()}
    # Only unquoted blanks around a value are trimmed by the reader.
    expected = {r[:3] + (r[3].strip(),) + r[4:] for r in rows}
    assert got == expected
    files.write_scored_csv(spark.createDataFrame(rows[:1], SCORED), path)
    assert files.read_scored_csv(spark, path).count() == 1


def test_empty_text_reads_as_null(spark, tmp_path):
    path = str(tmp_path / "scored")
    row = (1, "A", "c", "", 1.0, "d", 1, 0.0)
    files.write_scored_csv(spark.createDataFrame([row], SCORED), path)
    assert files.read_scored_csv(spark, path).first().review is None


def test_long_ids(spark, tmp_path):
    big = 3_000_000_000
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([(big, "A", "c", "r", 1.0, "d", 1)], RAW)
    files.write_reviews_tsv(df, path)
    assert files.read_reviews_tsv(spark, path).first().UniqueID == big
    assert files.read_reviews_tsv(spark, path, with_int_ids(RAW)).first().UniqueID is None


def test_landed_folder(spark, tmp_path):
    root = tmp_path / "landed"
    header = ",".join(LANDED.fieldNames()) + "\n"
    for month, n in (("9-2022", 1), ("10-2022", 2)):
        for i in range(n):
            folder = root / f"month_dir={month}" / f"batch_id={i}"
            folder.mkdir(parents=True)
            (folder / "a.csv").write_text(header + f'"good, ""really""",{i},d,c,x,5,0.5\n')
    df = files.read_landed(spark, str(root))
    assert df.columns == [*LANDED.fieldNames(), "month_dir"]
    assert df.count() == 3
    assert df.first().review == 'good, "really"'
    october = files.read_landed(spark, str(root), ["10-2022"])
    assert october.count() == 2
    plan = october._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_dir" in plan or "month_dir" in plan.split(
        "PartitionFilters: [")[1].split("]")[0]


def test_predictions_keep_other_runs(spark, tmp_path):
    path = str(tmp_path / "predictions")
    df = spark.createDataFrame([(1, 0.5, 7.0)], "UniqueID int, sentiment double, prediction double")
    files.write_predictions(df, path, "a")
    files.write_predictions(df, path, "b")
    files.write_predictions(df, path, "b")
    assert sorted(r.run_ts for r in spark.read.parquet(path).collect()) == ["a", "b"]
    files.write_predictions(df, path)
    assert spark.read.parquet(path).count() == 3


def test_from_local_and_append(spark):
    a = files.from_local(spark, [(1, 0.5)], "usefulCount int, sentiment double")
    b = files.from_local(spark, [(0.5, 1), (0.1, 2)], "sentiment double, usefulCount int")
    c = files.from_local(spark, [("x",)], "note string")
    both = files.append(a, b, c)
    assert both.columns == ["usefulCount", "sentiment", "note"]
    assert both.where("usefulCount = 1 AND sentiment = 0.5").count() == 2
    assert both.count() == 4


def test_landed_files_are_read_by_name(spark, tmp_path):
    names = LANDED.fieldNames()
    plain, indexed, wrong = (tmp_path / n for n in ("plain", "indexed", "wrong"))
    for folder, header, row in (
        (plain, ",".join(names), "good,7,d,c,x,5,0.5"),
        (indexed, "," + ",".join(names), "0,good,7,d,c,x,5,0.5"),
        (wrong, ",".join(reversed(names)), "0.5,5,x,c,d,7,good"),
    ):
        folder.mkdir()
        (folder / "a.csv").write_text(f"{header}\n{row}\n")
    want = ("good", 7, "d", "c", "x", 5, 0.5, None)
    assert tuple(files.read_landed(spark, str(plain)).first()) == want
    assert tuple(files.read_landed(spark, str(indexed), index_column=True).first()) == want
    with pytest.raises(Exception):
        files.read_landed(spark, str(wrong)).collect()
    with pytest.raises(Exception):
        files.read_landed(spark, str(indexed)).collect()
    with pytest.raises(Exception):
        files.read_landed(spark, str(plain), index_column=True).collect()
    # Each file's header counts, not that of the first one listed.
    for name, text in (("b.csv", f",{','.join(names)}\n0,fine,8,d,c,x,5,0.5\n"), ("c.csv", f"{','.join(names)}\n12,9,Ache,d2,4,3,1\n")):
        (indexed / name).write_text(text)
        if name == "b.csv":
            assert files.read_landed(spark, str(indexed), index_column=True).count() == 2
    for index in (True, False):
        with pytest.raises(Exception):
            files.read_landed(spark, str(indexed), index_column=index).collect()
