import random

import numpy as np
import pytest

from sparkfold.llm import suffix_repeats as sr


def brute(docs):
    least = {}
    for d, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            g = data[i : i + 50]
            least[g] = min(least.get(g, (d is not None, d or 0)), (d is not None, d or 0))
    out = []
    for d, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - 49):
            if least[data[i : i + 50]] < (d is not None, d or 0):
                gone[i : i + 50] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((d, kept, [list(map(int, e)) for e in edges.reshape(-1, 2)]))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, bytes(r.data), r.spans) for r in df.collect()), key=repr)


def make(draw, n):
    letters = "ab é"
    text = lambda k: "".join(draw.choices(letters, k=k))
    passages = [text(draw.randrange(40, 160)) for _ in range(12)]
    out = []
    for d in range(n):
        parts = []
        for _ in range(draw.randrange(5)):
            p = draw.choice(passages)
            a = draw.randrange(len(p))
            parts += [text(draw.randrange(60)), p[a // 3 :] if draw.random() < 0.5 else p]
        out.append((d, "".join(parts)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("BATCH", 500), ("SLICE", 300), ("ANCHOR_PART", 2000), ("CONTEXT_PART", 1000)):
            monkeypatch.setattr(sr, name, value)
    docs = make(random.Random(6), 120)
    docs += [(200, docs[3][1]), (201, docs[3][1]), (-5, docs[7][1]), (202, None), (203, ""), (204, "x" * 49)]
    docs += [(205, "x" * 49), (206, "x" * 3000), (207, "x" * 70), (208, "\x00" * 60), (209, "a" + "\x00" * 60)]
    docs += [(None, docs[10][1]), (210, docs[12][1][:80]), (210, docs[12][1][:80])]
    # different texts under one id, and without one
    docs += [(5, docs[30][1]), (5, "y" + docs[31][1]), (40, docs[32][1] + docs[33][1]), (40, "z" * 70 + docs[34][1])]
    docs += [(None, docs[35][1] + "!"), (None, "?" + docs[36][1]), (300, docs[30][1]), (-9, docs[37][1]), (-9, "z" * 60)]
    df = spark.createDataFrame([(*r, b"x") for r in docs], "doc_id long, text string, data binary")
    assert found(sr.without_repeats(df)) == brute(docs)
    assert sr.without_repeats(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a" * 60), (2, "b" * 60), (2, "a" * 60), (2, "c" * 60)], df.schema[:2])
    assert [len(r.data) for r in sr.without_repeats(twice).orderBy("doc_id", "data").collect()] == [60, 0, 60, 60]


def test_query(spark, data):
    from sparkfold.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    want = {d: (kept, spans) for d, kept, spans in brute(docs)}
    import hashlib

    for r in QUERIES["op7_suffix_dedup"](spark, data).collect():
        kept, spans = want[r.doc_id]
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert (r.n_spans, r.n_removed) == (len(spans), sum(b - a for a, b in spans))
        assert r.n_bytes == len(kept) + r.n_removed


def test_maximal_repeats():
    draw = np.random.default_rng(3)
    a, b, c = (draw.integers(97, 123, n).astype(np.uint8) for n in (60, 70, 55))
    texts = [np.concatenate(x) for x in ((a, b, c), (c, b, a), (b[5:], a, b[:50]))]
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths) - lengths
    data = np.concatenate(texts)
    groups = {(n, tuple(sorted(p.tolist()))) for n, p in sr.maximal_repeats(data, starts, lengths)}
    places = {}
    raw = data.tobytes()
    for w, s in enumerate(starts):
        for i in range(lengths[w] - 49):
            places.setdefault(raw[s + i : s + i + 50], []).append(s + i)
    assert all(raw[p : p + n] == raw[at[0] : at[0] + n] for n, at in groups for p in at)
    # every repeat of 50 bytes lies in a group that has all of its places
    for at in (x for x in places.values() if len(x) > 1):
        assert any(
            len(at) <= len(g) and all(any(q <= p and p + 50 <= q + n for q in g) for p in at) for n, g in groups
        )


def test_anchors_cover_all_windows():
    draw = np.random.default_rng(1)
    data = draw.integers(97, 101, 4000).astype(np.uint8)
    ends = np.array([30, 80, 1000, 1049, 4000])
    _, at, first, last = sr.anchors(data, ends)
    windows = [s for f, l in zip(first, last) for s in range(f, l + 1)]
    begin = [0, *ends[:-1]]
    assert windows == [s for a, b in zip(begin, ends) for s in range(a, b - 49)]
    assert (at >= last).all() and (at + 16 <= first + 50).all()
