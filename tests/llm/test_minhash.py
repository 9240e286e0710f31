import random

import numpy as np
import pytest

from sparkfold.llm import minhash as mh
from sparkfold.llm.queries import QUERIES


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and sets[i]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * len(sets[i] | sets[j]):
                    old, new = label[i], label[j]
                    label = [new if x == old else x for x in label]
    least = {}
    for (d, _), k in zip(rows, label):
        known = [x for x in (least.get(k), d) if x is not None]
        least[k] = min(known) if known else None
    return sorted(((d, len(s), least[k], d == least[k]) for (d, _), s, k in zip(rows, sets, label)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert found(QUERIES["op11_minhash_dedup"](spark, data)) == brute(rows)


def hostile():
    draw = random.Random(5)

    def variants(n, length, edits):
        base = [f"w{draw.randrange(400)}" for _ in range(length)]
        for _ in range(n):
            words = list(base)
            for _ in range(draw.randrange(edits + 1)):
                words[draw.randrange(length)] = f"x{draw.randrange(10**6)}"
            yield " ".join(words)

    texts = [*variants(90, 150, 9), *variants(25, 60, 3), *["Same TEXT of five words"] * 9, "same text OF five words"]
    # a chain: each one links with the next, the ends do not
    chain = [f"c{i}" for i in range(140)]
    texts += [" ".join(chain[i * 4 : i * 4 + 80]) for i in range(12)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"q{draw.randrange(10**6)}" for _ in range(20)) for _ in range(40)]
    texts += [None, "", " \n", "One", "one", "one two", "ONE\ttwo", "É a b", "é a b", "z " * 30_000, "z z z"]
    rows = list(enumerate(texts)) + [(None, "one"), (3, texts[3]), (None, "alone here"), (None, "")]
    return rows + [(5, "another text under a known id"), (None, texts[0] + " y"), (None, texts[0] + " y")]


@pytest.mark.parametrize("few", [100_000, 0])
def test_hot_groups_and_edges(spark, monkeypatch, few):
    monkeypatch.setattr(mh, "BLOCK", 8)
    monkeypatch.setattr(mh, "STAR", 8)
    monkeypatch.setattr(mh, "FEW_ROWS", few)
    monkeypatch.setattr(mh, "HOT", 20)
    rows = hostile()
    df = spark.createDataFrame([(*r, b"x", 1) for r in rows], "doc_id long, text string, record binary, n int")
    assert found(mh.near_duplicates(df)) == brute(rows)
    if few:
        assert mh.near_duplicates(df.limit(0)).count() == 0
        assert found(mh.near_duplicates(df.where("text = ''"))) == brute([r for r in rows if r[1] == ""])


def test_buckets_of_several_components(spark):
    # a linked with b and c with d, and only b with c; a is the bucket's least: the last link needs the blocks
    words = [f"w{i}" for i in range(100)]
    texts = {"a": words, "b": words[6:] + ["b"] * 6, "c": words[12:] + ["b"] * 12}
    rows = [(i, " ".join(t)) for i, t in enumerate(texts.values())]
    functions = mh.universal(mh.BANDS * mh.ROWS)
    sets = [mh.shingle_set(t, mh.WIDTH) for _, t in rows]
    data = [
        (bytearray(mh.name_of(s)), i, len(s), len(t), bytearray(mh.minima(s, functions).astype(np.uint8).tobytes()),
         [1, *range(10 * i + 2, 10 * i + 2 + mh.BANDS - 1)])
        for (i, t), s in zip(rows, sets)
    ]
    distinct = spark.createDataFrame(
        data, "record binary, least long, n long, size long, signs binary, bands array<long>"
    )
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    linked = {bytes(r.record): bytes(r.component) for r in mh.linked_sets(distinct, docs, 85).collect()}
    want = {d: c for d, _, c, _ in brute(rows)}
    own = [linked.get(bytes(r[0]), bytes(r[0])) for r in data]
    assert [own.index(x) for x in own] == [want[i] for i in range(3)]


def test_star_components(spark, monkeypatch):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)]
    links += [(2000, 2001 + i) for i in range(60)] + [(3, 3)]
    df = spark.createDataFrame([(b"%04d" % a, b"%04d" % b) for a, b in links], "a binary, b binary")
    label = {}
    for a, b in links:
        x, y = label.setdefault(a, a), label.setdefault(b, b)
        label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    want = {(b"%04d" % k, b"%04d" % v) for k, v in label.items() if k != 3 or v != 3 or 3 in {a for a, b in links if a != b}}
    for few in (100_000, 0):
        monkeypatch.setattr(mh, "FEW_ROWS", few)
        got = [(bytes(r.record), bytes(r.component)) for r in mh.star_components(df).collect()]
        linked = {x for a, b in links if a != b for x in (b"%04d" % a, b"%04d" % b)}
        assert len(got) == len(set(got)) and set(got) == {w for w in want if w[0] in linked}


def test_recall_of_bands():
    assert (1 - 0.85**mh.ROWS) ** mh.BANDS < 2e-6
    draw = np.random.default_rng(2)
    functions = mh.universal(mh.BANDS * mh.ROWS)
    agree = []
    for _ in range(40):
        pool = draw.integers(0, 2**64, 1080, dtype=np.uint64)
        a, b = mh.minima(pool[:1000], functions), mh.minima(pool[80:], functions)
        agree.append((a == b).mean())
        assert (mh.band_keys(a) == mh.band_keys(b)).any()
    assert abs(np.mean(agree) - 920 / 1080) < 0.02
