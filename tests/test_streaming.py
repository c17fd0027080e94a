import base64
import json
import os

import pytest
from pyspark.sql import functions as F

from medvoice.functions.lexicon import LEXICON
from medvoice.operators import rating_model as M
from medvoice.operators.polarity import text_polarity
from medvoice.sources import files, messages
from medvoice.streaming.landing import land_messages, landed_columns
from medvoice.streaming.scoring import landed_source, predicted_columns, score_landed
from medvoice.workspace import materialize, new_folder, shared_root

# The two sample messages.
GOOD = {
    "UniqueID": 1234, "drugName": "Dolo", "condition": "Fever", "review": "Fantastic",
    "rating": 10, "date": "11-30-2022", "usefulCount": 100,
}
BAD = dict(GOOD, UniqueID=1235, review="Worst didn't work", rating=0, date="10-30-2022", usefulCount=10)


def encode(message):
    text = message if isinstance(message, str) else json.dumps(message)
    return base64.b64encode(text.encode()).decode()


def publish(folder, name, *bodies):
    folder.mkdir(exist_ok=True)
    # Appear whole, as a message store would deliver.
    hidden = folder / f".{name}"
    hidden.write_text("".join(b + "\n" for b in bodies))
    os.rename(hidden, folder / name)


def without(message, key):
    return {k: v for k, v in message.items() if k != key}


def test_decoding(spark):
    bodies = [
        encode(GOOD), encode(BAD), encode("not json"), "%%%",
        encode(without(GOOD, "review")), encode(without(GOOD, "rating")),
        encode(dict(GOOD, UniqueID="x")), encode(dict(GOOD, extra=1)),
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "data string")
    rows = {r.data: r for r in messages.decode_messages(df).collect()}
    usable = [rows[b].usable for b in bodies]
    assert usable == [True, True, False, False, False, True, False, True]
    assert rows[bodies[0]].rating == 10.0 and rows[bodies[1]].rating == 0.0


def test_encode_round_trip(spark):
    row = (1, "A", "c", "x" * 500 + "\n\"é", 1.0, "d", 2)
    df = spark.createDataFrame(
        [row], "UniqueID int, drugName string, condition string, review string, rating double, date string, usefulCount int"
    )
    encoded = messages.encode_messages(df)
    assert "\n" not in encoded.first().data
    decoded = messages.decode_messages(encoded).first()
    assert tuple(decoded)[1:8] == row and decoded.usable


@pytest.fixture
def folders(tmp_path):
    return {n: tmp_path / n for n in (
        "messages", "landed", "rejects", "landing", "scoring", "predictions", "archive")}


def land(spark, f):
    land_messages(
        messages.message_source(spark, str(f["messages"])),
        str(f["landed"]), str(f["rejects"]), str(f["landing"]),
    ).awaitTermination()


def test_landing(spark, folders):
    publish(folders["messages"], "a.txt", encode(GOOD), encode("garbage"), encode(without(BAD, "review")))
    land(spark, folders)
    publish(folders["messages"], "b.txt", encode(BAD))
    land(spark, folders)
    land(spark, folders)  # nothing new
    landed = files.read_landed(spark, str(folders["landed"]))
    rows = {r.UniqueID: r for r in landed.collect()}
    assert set(rows) == {1234, 1235} and landed.count() == 2
    assert rows[1234].sentiment > 0 > rows[1235].sentiment
    now = spark.sql("SELECT concat(month(now()), '-', year(now()))").first()[0]
    assert rows[1234].month_dir == now
    rejected = spark.read.text(str(folders["rejects"]) + "/*/*")
    assert {r.value for r in rejected.collect()} == {encode("garbage"), encode(without(BAD, "review"))}
    # The stream equals the batch.
    batch = landed_columns(spark.createDataFrame([(encode(GOOD),), (encode(BAD),)], "data string"))
    columns = ["review", "UniqueID", "sentiment"]
    assert set(map(tuple, batch.select(*columns).collect())) == set(
        map(tuple, landed.select(*columns).collect())
    )


def test_a_batch_is_kept_once_without_the_bodies_of_usable_messages(spark, folders, monkeypatch):
    kind, kept = type(spark.range(0)), []
    real = kind.persist

    def persist(df, *args, **more):
        kept.append(sorted(r.data or "" for r in df.select("data").collect()))
        return real(df, *args, **more)

    monkeypatch.setattr(kind, "persist", persist)
    publish(folders["messages"], "a.txt", encode(GOOD), encode("garbage"), encode(BAD))
    land(spark, folders)
    assert kept == [["", "", encode("garbage")]]
    assert files.read_landed(spark, str(folders["landed"])).count() == 2
    assert [r.value for r in spark.read.text(str(folders["rejects"]) + "/*/*").collect()] == [encode("garbage")]


def test_repeated_batch_lands_once(spark, folders):
    publish(folders["messages"], "a.txt", encode(GOOD), encode(BAD))
    land(spark, folders)
    # Lose the commit of the batch, as if the job had died right after writing.
    for name in ("0", ".0.crc"):
        path = folders["landing"] / "commits" / name
        if path.exists():
            path.unlink()
    land(spark, folders)
    assert files.read_landed(spark, str(folders["landed"])).count() == 2


def test_scoring_and_archive(spark, folders):
    data = [(i % 50, s, 5.0 + 4 * s) for i in range(40) for s in (-1.0, 0.0, 0.75)]
    model = M.fit_rating_model(
        spark.createDataFrame(data, "usefulCount int, sentiment double, rating double"), numTrees=3
    )

    def score():
        source = landed_source(spark, str(folders["landed"]), str(folders["archive"]))
        score_landed(
            model, source, str(folders["predictions"]), str(folders["scoring"])
        ).awaitTermination()
        return spark.read.parquet(str(folders["predictions"]))

    def csv_files(folder):
        return [n for _, _, names in os.walk(folder) for n in names if n.endswith(".csv")]

    def arrive(i, *bodies):
        publish(folders["messages"], f"{i}.txt", *bodies)
        land(spark, folders)

    arrive(1, encode(GOOD))
    arrive(2, encode(BAD))
    assert score().count() == 2
    arrive(3, encode(dict(GOOD, UniqueID=3)))
    assert score().count() == 3
    rows = {r.UniqueID: r for r in score().collect()}
    assert set(rows) == {1234, 1235, 3}
    assert rows[1234].prediction > rows[1235].prediction
    assert all(r.run_ts for r in rows.values())
    # Archived files left the landing folder, nothing was lost or scored twice.
    archived, waiting = csv_files(folders["archive"]), csv_files(folders["landed"])
    assert len(archived) + len(waiting) == 3 and len(archived) >= 2
    score()
    assert score().count() == 3


def test_incomplete_row_is_kept_without_prediction(spark):
    data = [(i, 0.5, 6.0) for i in range(20)]
    model = M.fit_rating_model(
        spark.createDataFrame(data, "usefulCount int, sentiment double, rating double"), numTrees=1
    )
    df = spark.createDataFrame([(1, 3, 0.5), (2, None, 0.5)], "UniqueID int, usefulCount int, sentiment double")
    rows = {r.UniqueID: r for r in predicted_columns(model, df).collect()}
    assert rows[1].prediction == 6.0 and rows[2].prediction is None
    assert rows[2].usefulCount is None and rows[1].usefulCount == 3


def test_workspace(spark):
    root = shared_root(spark)
    assert shared_root(spark) == root
    a, b = new_folder(spark, "x"), new_folder(spark, "x")
    assert a != b and a.startswith(root + "/")
    df = materialize(spark.range(5).select(F.col("id").cast("int")), "ids")
    assert df.dtypes == [("id", "int")] and df.count() == 5


def test_command_line(spark, folders, tmp_path):
    from medvoice.__main__ import main

    raw, scored, model = (str(tmp_path / n) for n in ("raw", "scored", "model"))
    rows = [(i, "A", "c", t, r, "d", i % 5) for i, (t, r) in enumerate([("great", 9.0), ("awful", 2.0)] * 20)]
    files.write_reviews_tsv(
        spark.createDataFrame(
            rows, "UniqueID int, drugName string, condition string, review string, rating double, date string, usefulCount int"
        ),
        raw,
    )
    f = {k: str(v) for k, v in folders.items()}
    publish(folders["messages"], "a.txt", encode(GOOD), encode(BAD))
    lexicon = tmp_path / "lexicon.csv"
    lexicon.write_text("word,polarity\nfantastic,1.0\nworst,-1.0\ngreat,0.5\nawful,-0.5\n")
    main(["extract", raw, scored, "--format", "parquet", "--lexicon", str(lexicon)])
    assert {r.sentiment for r in spark.read.parquet(scored).collect()} == {0.5, -0.5}
    main(["train", scored, scored, model, "--format", "parquet"])
    main(["extract", raw, scored])
    main(["train", scored, scored, model])
    main(["land", f["messages"], f["landed"], f["rejects"], f["landing"], "--lexicon", str(lexicon), "--max-files", "5"])
    main(["score", model, f["landed"], f["predictions"], f["scoring"], "--archive", f["archive"]])
    assert spark.read.parquet(f["predictions"]).count() == 2
    main(["profile", raw, str(tmp_path / "profile")])
    assert spark.read.parquet(str(tmp_path / "profile" / "rating_percent")).count() == 2


def test_old_files_are_landed(spark, folders):
    publish(folders["messages"], "new.txt", encode(GOOD))
    publish(folders["messages"], "old.txt", encode(BAD))
    long_ago = os.path.getmtime(folders["messages"] / "new.txt") - 400 * 86_400
    os.utime(folders["messages"] / "old.txt", (long_ago, long_ago))
    land(spark, folders)
    publish(folders["messages"], "older.txt", encode(dict(GOOD, UniqueID=5)))
    os.utime(folders["messages"] / "older.txt", (long_ago - 86_400, long_ago - 86_400))
    land(spark, folders)
    landed = files.read_landed(spark, str(folders["landed"]))
    assert {r.UniqueID for r in landed.collect()} == {1234, 1235, 5}


def test_long_ids_through_landing_and_scoring(spark, folders):
    big = 3_000_000_000
    publish(folders["messages"], "a.txt", encode(dict(GOOD, UniqueID=big)))
    land(spark, folders)
    model = M.fit_rating_model(
        spark.createDataFrame([(i, 0.5, 6.0) for i in range(9)], "usefulCount int, sentiment double, rating double"),
        numTrees=1,
    )
    score_landed(
        model, landed_source(spark, str(folders["landed"])), str(folders["predictions"]), str(folders["scoring"])
    ).awaitTermination()
    assert [r.UniqueID for r in spark.read.parquet(str(folders["predictions"])).collect()] == [big]


def test_two_streams_and_a_renewed_checkpoint(spark, folders, tmp_path):
    for i, checkpoint in enumerate(("one", "two", "renewed")):
        folder = tmp_path / f"messages{i}"
        publish(folder, "a.txt", encode(dict(GOOD, UniqueID=i)), encode("junk"))
        land_messages(
            messages.message_source(spark, str(folder)),
            str(folders["landed"]), str(folders["rejects"]), str(tmp_path / checkpoint),
        ).awaitTermination()
    landed = files.read_landed(spark, str(folders["landed"]))
    assert sorted(r.UniqueID for r in landed.collect()) == [0, 1, 2]


def test_repeated_batch_is_not_scored_again(spark, folders):
    model = M.fit_rating_model(
        spark.createDataFrame([(i, 0.5, 6.0) for i in range(9)], "usefulCount int, sentiment double, rating double"),
        numTrees=1,
    )

    def score():
        score_landed(
            model, landed_source(spark, str(folders["landed"])), str(folders["predictions"]), str(folders["scoring"])
        ).awaitTermination()
        return spark.read.parquet(str(folders["predictions"])).count()

    publish(folders["messages"], "a.txt", encode(GOOD), encode(BAD))
    land(spark, folders)
    assert score() == 2
    for name in ("0", ".0.crc"):
        path = folders["landing"] / "commits" / name
        if path.exists():
            path.unlink()
    land(spark, folders)
    assert score() == 2


def test_large_lexicon_on_a_stream(spark, folders):
    padded = {**LEXICON, **{f"unused{i}": 0.5 for i in range(5_001)}}
    publish(folders["messages"], "a.txt", encode(GOOD), encode(BAD))
    land_messages(
        messages.message_source(spark, str(folders["messages"])),
        str(folders["landed"]), str(folders["rejects"]), str(folders["landing"]), padded,
    ).awaitTermination()
    rows = {r.UniqueID: r.sentiment for r in files.read_landed(spark, str(folders["landed"])).collect()}
    assert rows == {1234: text_polarity(spark, GOOD["review"]), 1235: text_polarity(spark, BAD["review"])}
