"""Batches published by manifests."""

import os

import pytest
from pyspark.sql import functions as F

from medvoice.operators import rating_model as M
from medvoice.sources import messages
from medvoice.streaming import manifest
from medvoice.streaming.landing import land_messages, read_landed_manifests
from medvoice.streaming.scoring import manifest_source, read_predictions_manifests, score_landed_manifests
from tests.test_streaming import BAD, GOOD, encode, publish, without


@pytest.fixture
def folders(tmp_path):
    return {n: tmp_path / n for n in ("messages", "landed", "rejects", "landing", "scoring", "predictions")}


def land(spark, f, landing="landing", incoming="messages"):
    land_messages(
        messages.message_source(spark, str(f[incoming])),
        str(f["landed"]), str(f["rejects"]), str(f[landing]), manifests=True,
    ).awaitTermination()


def ids(spark, f, months=None):
    return sorted(r.UniqueID for r in read_landed_manifests(spark, str(f["landed"]), months).collect())


def lose_commit(checkpoint):
    for name in ("0", ".0.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)


def test_landing(spark, folders):
    assert ids(spark, folders) == []
    publish(folders["messages"], "a.txt", encode(GOOD), encode("garbage"), encode(without(BAD, "review")))
    land(spark, folders)
    publish(folders["messages"], "b.txt", encode(BAD))
    land(spark, folders)
    land(spark, folders)
    assert ids(spark, folders) == [1234, 1235]
    row = read_landed_manifests(spark, str(folders["landed"])).first()
    assert ids(spark, folders, [row.month_dir]) == [1234, 1235] and ids(spark, folders, ["1-1999"]) == []
    rejected = spark.read.text([f"{folders['rejects']}/{r.path}" for r in manifest.committed_files(spark, str(folders["rejects"])).collect()])
    assert {r.value for r in rejected.collect()} == {encode("garbage"), encode(without(BAD, "review"))}


def test_failure_before_the_manifest(spark, folders, monkeypatch):
    """Files without a manifest are no part of the table; the next run lands them once."""
    publish(folders["messages"], "a.txt", encode(GOOD), encode(BAD))
    real = manifest._publish

    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr(manifest, "_publish", fail)
    with pytest.raises(Exception, match="lost"):
        land(spark, folders)
    left = [n for _, _, names in os.walk(folders["landed"]) for n in names if n.endswith(".csv")]
    assert left and ids(spark, folders) == []
    assert manifest.abandoned_files(spark, str(folders["landed"])).count() == len(left)
    monkeypatch.setattr(manifest, "_publish", real)
    land(spark, folders)
    assert ids(spark, folders) == [1234, 1235]
    assert manifest.abandoned_files(spark, str(folders["landed"])).count() == 0


def test_repeated_batch(spark, folders):
    publish(folders["messages"], "a.txt", encode(GOOD), encode(BAD))
    land(spark, folders)
    before = sorted(r.path for r in manifest.committed_files(spark, str(folders["landed"])).collect())
    lose_commit(folders["landing"])
    land(spark, folders)
    assert sorted(r.path for r in manifest.committed_files(spark, str(folders["landed"])).collect()) == before
    assert ids(spark, folders) == [1234, 1235]


def test_two_streams(spark, folders, tmp_path):
    for i, checkpoint in enumerate(("one", "two", "renewed")):
        folders[f"in{i}"], folders[checkpoint] = tmp_path / f"in{i}", tmp_path / checkpoint
        publish(folders[f"in{i}"], "a.txt", encode(dict(GOOD, UniqueID=i)), encode("junk"))
        land(spark, folders, checkpoint, f"in{i}")
    assert ids(spark, folders) == [0, 1, 2]


def test_half_written_manifest_is_not_seen(spark, folders):
    root = folders["landed"] / "_manifests"
    root.mkdir(parents=True)
    (root / ".s-1.half").write_text('{"path": "nowhere.csv", "bytes": 1}\n')
    assert ids(spark, folders) == []


def test_no_folder_is_moved(spark, folders):
    """Data files keep the names they were written with."""
    seen = []

    def write(folder):
        spark.range(5).write.parquet(folder)
        seen.append(sorted(n for n in os.listdir(folder) if n.startswith("part")))

    root = str(folders["landed"])
    assert manifest.commit(spark, root, "month_dir=1-2022/batch_id=0", "k", write)
    assert not manifest.commit(spark, root, "month_dir=1-2022/batch_id=0", "k", write)
    listed = [r.path for r in manifest.committed_files(spark, root).collect()]
    assert sorted(os.path.basename(p) for p in listed) == seen[0] and len(seen) == 1
    assert all(os.path.getsize(f"{root}/{r.path}") == r.bytes for r in manifest.committed_files(spark, root).collect())
    schema = spark.range(1).schema
    assert manifest.read_committed(spark, root, "parquet", schema, months=["1-2022"]).agg(F.sum("id")).first()[0] == 10


def test_scoring(spark, folders):
    data = [(i % 50, s, 5.0 + 4 * s) for i in range(40) for s in (-1.0, 0.0, 0.75)]
    model = M.fit_rating_model(
        spark.createDataFrame(data, "usefulCount int, sentiment double, rating double"), numTrees=3
    )

    def score():
        score_landed_manifests(
            model, manifest_source(spark, str(folders["landed"]), 1), str(folders["landed"]),
            str(folders["predictions"]), str(folders["scoring"]),
        ).awaitTermination()
        return sorted(r.UniqueID for r in read_predictions_manifests(spark, str(folders["predictions"])).collect())

    publish(folders["messages"], "a.txt", encode(GOOD))
    land(spark, folders)
    publish(folders["messages"], "b.txt", encode(BAD))
    land(spark, folders)
    assert score() == [1234, 1235]
    publish(folders["messages"], "c.txt", encode(dict(GOOD, UniqueID=3)), encode("junk"))
    land(spark, folders)
    publish(folders["messages"], "d.txt", encode("only junk"))
    land(spark, folders)
    assert score() == [3, 1234, 1235]
    for name in os.listdir(folders["scoring"] / "commits"):
        (folders["scoring"] / "commits" / name).unlink()
    assert score() == [3, 1234, 1235]
    assert all(r.prediction is not None for r in read_predictions_manifests(spark, str(folders["predictions"])).collect())
