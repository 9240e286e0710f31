import random

import numpy as np
import pytest
import pyarrow as pa

from sparkfold.llm import jaccard_join as jj
from sparkfold.llm.queries import ORACLE, QUERIES


def shingles(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    label, links = list(range(len(rows))), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), k in zip(rows, label):
        known = [x for x in (least.get(k), d) if x is not None]
        least[k] = min(known) if known else None
    return sorted(((d, least[k], n) for (d, _), k, n in zip(rows, label, links)), key=str)


def found(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert found(QUERIES["op10_jaccard_join"](spark, data)) == brute(rows)


def variants(draw, n, length, edits):
    base = [f"w{draw.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(draw.randrange(edits + 1)):
            words[draw.randrange(length)] = f"x{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_hot_group_and_edges(spark, monkeypatch):
    monkeypatch.setattr(jj, "SMALL", 8)
    monkeypatch.setattr(jj, "BLOCK", 16)
    draw = random.Random(3)
    texts = variants(draw, 60, 120, 6) + variants(draw, 20, 60, 2) + ["same text of five words"] * 9
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"q{draw.randrange(10**6)}" for _ in range(30)) for _ in range(40)]
    texts += [None, "", " \n", "one", "one", "one two", "a b c d e f"] + ["z " * 30_000, "z " * 30_001]
    rows = list(enumerate(texts)) + [(None, "one"), (3, texts[3]), (None, "alone here")]
    rows += [(5, "another text under a known id"), (None, texts[0] + " y"), (None, texts[0] + " y")]
    df = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, record binary")
    assert found(jj.jaccard_join(df)) == brute(rows)
    assert jj.jaccard_join(df.limit(0)).count() == 0


def test_sketch_and_draw():
    draw = np.random.default_rng(1)
    hashes = np.unique(draw.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2))
    assert len(jj.sketch(hashes)) == jj.BINS and jj.sketch(hashes[:0]) == bytes(jj.BINS)
    sizes = [len(jj.drawn(hashes[i::4], 200, 0.8)) for i in range(4)]
    assert all(200 < n < 300 for n in sizes)
    assert jj.runs_for(0.9999) == 15
    i, j = jj._pairs_within(np.array([3, 2, 1]))
    assert list(zip(i, j)) == [(0, 1), (0, 2), (1, 2), (3, 4)]


def test_recall_below_the_second_level(spark, monkeypatch):
    # every token is in half of all sets: nodes of 400, 200, 100 and so on, seven levels
    monkeypatch.setattr(jj, "SMALL", 8)
    draw = np.random.default_rng(8)
    pool = np.unique(draw.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2))
    rows, pairs = [], []
    for _ in range(400):
        has = draw.random(len(pool)) < 0.5
        other = has.copy()
        moved = int(has.sum()) // 9
        other[draw.choice(np.flatnonzero(has), moved, replace=False)] = False
        other[draw.choice(np.flatnonzero(~has), moved, replace=False)] = True
        sets = [pool[has], pool[other]]
        assert (has & other).sum() >= 0.8 * (has | other).sum()
        pairs.append([jj.name_of(s) for s in sets])
        rows += [
            (jj.name_of(s), len(s), jj.sketch(s), jj.drawn(s, jj.runs_for(0.9999), 0.8).view(np.int64).tolist())
            for s in sets
        ]
    df = spark.createDataFrame(rows, "record binary, n long, sketch binary, nodes array<long>")
    label = {r[0]: r[0] for r in rows}
    label |= {bytes(r.id): bytes(r.component) for r in jj.candidate_clusters(df, 0.8).collect()}
    assert len(set(label.values())) > 300
    assert not [a for a, b in pairs if label[a] != label[b]]


def test_a_group_of_near_copies_is_not_drawn_again(spark, monkeypatch):
    # some are too far from others for one star; their nodes must not grow from level to level
    draw = random.Random(5)
    texts = variants(draw, 500, 120, 8)
    sets = {jj.name_of(s): s for s in map(jj.shingle_set, texts)}
    assert len(sets) > jj.SMALL
    rows = [
        (n, jj.sketch(s), jj.drawn(s, jj.runs_for(0.9999), 0.8).view(np.int64).tolist()) for n, s in sets.items()
    ]
    sizes = {}
    kept = jj.kept_table

    def counted(df, name):
        table = kept(df, name)
        if name == "level":
            sizes[len(sizes)] = table.count()
        return table

    monkeypatch.setattr(jj, "kept_table", counted)
    df = spark.createDataFrame(rows, "record binary, sketch binary, nodes array<long>")
    label = {n: n for n in sets} | {bytes(r.id): bytes(r.component) for r in jj.candidate_clusters(df, 0.8).collect()}
    sets = [(n, set(s.tolist())) for n, s in sets.items()]
    near = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if len(s & t) >= 0.8 * len(s | t)]
    assert len(near) > 1000 and not [a for a, b in near if label[a] != label[b]]
    assert sum(sizes.values()) <= 2 * sum(len(r[2]) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_stars(seed):
    draw = np.random.default_rng(seed)
    i, j = draw.integers(0, 30, (2, 15))
    label = jj._stars(30, i, j)
    assert (label[i] == label[j]).all() and (label[label] == label).all()


def test_oracle_names():
    assert set(ORACLE) <= set(QUERIES)


def test_nodes_with_few_pairs_left_are_settled_at_once(spark, monkeypatch):
    # a passage that 60 unlike texts and pairs of near ones share: more than SMALL outside any cluster
    monkeypatch.setattr(jj, "SMALL", 16)
    draw = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(12))
    tail = lambda n: " ".join(f"q{draw.randrange(10**6)}" for _ in range(n))
    texts = [f"{passage} {tail(30)}" for _ in range(20)]
    texts += [x + end for x in (f"{passage} {tail(60)}" for _ in range(20)) for end in ("", " more")]
    texts += [tail(12) for _ in range(1500)]
    names, kept = [], jj.kept_table

    def counted(df, name):
        names.append(name)
        return kept(df, name)

    monkeypatch.setattr(jj, "kept_table", counted)
    rows = list(enumerate(texts))
    assert found(jj.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert "mixed" in names and "level" not in names


@pytest.mark.parametrize("few", [0, 100_000])
def test_components_of_few_and_of_many_links(spark, monkeypatch, few):
    from sparkfold.llm import common

    tables, kept = [], common.kept_table
    monkeypatch.setattr(common, "FEW_ROWS", few)
    monkeypatch.setattr(common, "kept_table", lambda df, name: tables.append(name) or kept(df, name))
    draw = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(draw.randrange(100, 200), draw.randrange(100, 200)) for _ in range(60)]
    label = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for a, b in links:
        if a != b:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {x: new if k == old else k for x, k in label.items()}
    df = spark.createDataFrame(links + [(None, 3), (7, 7)], "a long, b long")
    assert {r.id: r.component for r in common.components(df).collect()} == label
    assert (len(tables) == 2) == (few > 0)


def test_workers_remember_no_words_after_a_task(spark):
    from sparkfold.llm import shingles

    def remembered(batches):
        yield from (pa.RecordBatch.from_pydict({"n": [len(shingles._WORDS)] * b.num_rows}) for b in batches)

    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(50))) for i in range(64)], "doc_id long, text string")
    # the operator's own functions end with a forgotten table, in whatever worker they ran
    jj.jaccard_join(docs.repartition(8)).collect()
    left = spark.range(0, 64, 1, 16).mapInArrow(jj.forgetting(remembered), "n long").collect()
    assert len(left) == 64
    jj._records(docs.repartition(16), 2, 0.8).collect()
    assert {r.n for r in spark.range(0, 64, 1, 16).mapInArrow(remembered, "n long").collect()} == {0}
