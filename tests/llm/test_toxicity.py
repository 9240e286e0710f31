import random
import zlib

import numpy as np
import pytest

from sparkfold.llm import toxicity
from sparkfold.llm.queries import QUERIES


def corpus(seed, n, toxic_share=0.15):
    draw = random.Random(seed)
    rows = []
    for d in range(n):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(5, 120))]
        toxic = draw.random() < toxic_share
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["vile", "foul", "nasty", "hateful"]))
        rows.append((d, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(1, 1500)
    docs = spark.createDataFrame([(d, t, 0.5) for d, t, _ in rows], "doc_id long, text string, score double")
    # half of the toxic documents are confirmed, nothing is known to be clean
    known = [(d, y) for d, _, y in rows if y and d % 2] + [(None, 1), (3, None)]
    labels = spark.createDataFrame(known, "doc_id long, toxic int")
    return toxicity.fit(docs, labels, prior=0.15), docs


def test_learns_from_positive_and_unlabelled(spark, fitted):
    model, _ = fitted
    rows = corpus(2, 600)
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    hits = sum((score[d] >= 0.3) == bool(y) for d, _, y in rows)
    assert hits / len(rows) > 0.95
    assert all(0 <= s <= 1 for s in score.values())


def test_edges(spark, fitted):
    model, docs = fitted
    rows = [(1, None), (1, None), (None, ""), (2, "vile " * 40_000), (3, "!!!")]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, f int, row string")
    out = toxicity.with_score(df, model)
    assert out.columns == [*df.columns, "score"] and out.count() == 5
    scores = {r.text: r.score for r in out.collect()}
    assert scores[None] == scores[""] == scores["!!!"] < scores["vile " * 40_000]
    assert toxicity.with_score(docs, model).columns == ["doc_id", "text", "score"]
    assert toxicity.score(df.limit(0), model).count() == 0
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    nothing = toxicity.fit(df.limit(0), empty)
    assert not nothing.weights.any()
    assert toxicity.fit(df, empty).bias == pytest.approx(np.log(0.01 / 0.99))


def test_sample_is_bounded(spark, fitted):
    _, docs = fitted
    p, u = toxicity.sample(docs, docs.where("doc_id < 200").select("doc_id"), 30, 50)
    assert len(p) == 30 and len(u) == 50


def test_query_learns_nothing_from_the_held_out(spark, data):
    out = QUERIES["op6_toxicity"](spark, data)
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3)
