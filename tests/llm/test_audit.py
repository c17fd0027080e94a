"""Filter interactions against plain loops."""

from __future__ import annotations

import random
import re
from itertools import permutations

import pytest

from medvoice.llm.filter_audit import RULES, audit, cells, interactions
from medvoice.llm.queries import QUERIES
from tests.llm.data import awkward, sentence

LAST = (1 << 63) - 1
SCHEMA = "doc_id long, text string, lang string"


def plain(docs, labels, letters="ABCDE"):
    """``(part, order, step) -> counts`` document by document and order by order."""
    good, toxic, first = {}, {}, {}
    for i, q, t in labels:
        if i is not None:
            good[i] = good.get(i, False) or q == 1
            toxic[i] = toxic.get(i, False) or t == 1
    for i, text, _ in docs:
        i = LAST if i is None else i
        first[text or ""] = min(first.get(text or "", LAST), i)
    out, every = {}, {}
    for part in {lang or "" for _, _, lang in docs}:
        own = []
        for i, text, lang in docs:
            if (lang or "") != part:
                continue
            t = text or ""
            words = re.findall(r"[^\x20\x09-\x0D]+", t)
            fails = {
                "A": len(words) < 100,
                "B": 100 * len(set(words)) < 80 * len(words),
                "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                "D": re.search(r"[#$%&*|]", t) is not None,
                "E": (LAST if i is None else i) > first[t],
            }
            own.append(({x for x in letters if fails[x]}, good.get(i, False), toxic.get(i, False)))
        for order in permutations(letters):
            there = list(own)
            for step, x in enumerate(order, 1):
                gone = [d for d in there if x in d[0]]
                left = [d for d in there if x not in d[0]]
                all_fail = sum(x in d[0] for d in own)
                out[part, "".join(order), step] = [
                    len(left), len(gone), all_fail - len(gone), sum(d[0] == {x} for d in own),
                    sum(d[1] for d in gone), sum(d[2] for d in gone),
                ]
                every[part, x] = every.get((part, x), 0) + len(gone)
                there = left
    return {k: (*v, every[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def table(df):
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in counts) for r in df.collect()}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    docs = [(i, t, rng.choice(["en", "de", "", None])) for i, t in awkward()]
    docs += [(200 + i, sentence(rng, 150) + rng.choice(["", " 5 % off", " LOUD" * 80]), "fr") for i in range(20)]
    docs += [(300 + i, "A shared text " * 40, rng.choice(["en", "fr", None])) for i in range(30)]
    docs += [(300, "A shared text " * 40, "en"), (None, "A shared text " * 40, None), (400, None, None), (401, "", "en")]
    docs += [(500, "word " * 300_000, "en"), (501, "#" * 200_000, "xx"), (502, "É" * 500, "xx"), (503, "no mark here ", "xx")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 520, 2)]
    return docs, labels + [(300, 1, 0), (300, 0, 1), (None, 1, 1), (9999, 1, 1)]


def test_against_loops(spark, corpus):
    docs, labels = corpus
    frame = spark.createDataFrame([(*d, "n", 7) for d in docs], SCHEMA + ", mask string, n_words int").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain(docs, labels)
    got = audit(frame, marks)
    assert table(got) == want
    assert got.count() == len(want) == 600 * len({lang or "" for _, _, lang in docs})


def test_other_filters(spark, corpus):
    docs, labels = corpus
    frame = spark.createDataFrame(docs, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    two = {k: RULES[k] for k in "AD"}
    assert table(audit(frame, marks, two, copies=None)) == plain(docs, labels, "AD")
    assert table(audit(frame, marks, two)) == plain(docs, labels, "ADE")
    with pytest.raises(ValueError):
        interactions(cells(frame, marks), list("ABCDEFG"))


def test_nothing(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(spark.createDataFrame([], SCHEMA), marks).count() == 0
    alone = table(audit(spark.createDataFrame([(None, None, None)], SCHEMA), marks))
    assert alone == plain([(None, None, None)], [])


def test_cells_leave_the_texts(spark, corpus):
    """No text and no Python in the shuffles; a hot text is counted before it is shuffled."""
    docs, labels = corpus
    frame = spark.createDataFrame(docs, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = audit(frame, marks)._jdf.queryExecution().explainString(mode)
    assert "InArrow" not in plan and "EvalPython" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    moved = re.findall(r"Exchange *\nInput \[\d+\]: \[(.*)\]", plan)
    assert len(moved) >= 4 and all("text#" not in m and "words" not in m for m in moved)


def test_query(spark, sf_dir):
    rows = QUERIES["op11_filter_audit"](spark, sf_dir)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert table(rows) == plain(docs, labels)
