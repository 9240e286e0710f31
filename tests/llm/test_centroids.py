import hashlib

import numpy as np
import pytest

from sparkfold.llm import centroids
from sparkfold.llm.queries import QUERIES


def brute(rows, dims, k, rounds, scale=64, seed=1):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    name = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else name(r[0]), r[1]))[:k]
    x, c = np.array([v for _, v in kept]), np.array([v for _, v in first])
    for r in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        if r < rounds:
            for j in range(len(c)):
                if (own == j).any():
                    c[j] = x[own == j].sum(axis=0) // (own == j).sum()
    return sorted(((i, int(j), int(q)) for (i, _), j, q in zip(kept, own, d.min(axis=1))), key=str)


def found(df):
    return sorted(((r[0], r[1], r[2]) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, data):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    got = QUERIES["op12_centroid_clusters"](spark, data)
    want = brute(rows, 64, 16, 3)
    assert found(got.select("vec_id", "cluster", "distance")) == want
    inertia = {}
    for _, c, q in want:
        inertia[c] = inertia.get(c, 0) + q
    assert {(r.cluster, r.cluster_inertia, r.inertia) for r in got.collect()} == {
        (c, s, sum(inertia.values())) for c, s in inertia.items()
    }


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [i % 3 - 1.0, 0.5, -0.25 * (i % 2)]) for i in range(40)] + [(50, [0.1, -0.1, 0.0])] * 3
    rows += [(None, [9.0, 9.0, 9.0]), (None, [9.0, 9.0, 8.0]), (51, None), (52, []), (53, [1.0, 2.0])]
    rows += [(54, [1.0, None, 2.0]), (55, [nan, 0.0, 0.0]), (56, [0.0, -inf, 0.0]), (57, [-0.0, 1e-40, -1e-40])]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "vec_id long, e array<float>, id int, cluster int")
    for k, rounds in [(1, 1), (4, 0), (5, 3), (100, 2)]:
        got, final = centroids.cluster(df, "vec_id", "e", dims=3, k=k, rounds=rounds)
        assert found(got) == brute(rows, 3, k, rounds)
        assert len(final) == min(k, 46)
    none, final = centroids.cluster(df.where("e IS NULL"), "vec_id", "e", dims=3, k=4, rounds=2)
    assert none.columns == ["id", "cluster", "distance"] and none.count() == len(final) == 0
    assert centroids.with_inertia(none, final).count() == 0
    large = spark.createDataFrame([(1, [1e30])], "vec_id long, e array<double>")
    with pytest.raises(Exception, match="must stay below"):
        centroids.cluster(large, "vec_id", "e", dims=1, k=1, rounds=1)


@pytest.mark.parametrize("span", [1, 4, 100, 2**27])
def test_walk_finds_the_nearest(span):
    draw = np.random.default_rng(span)
    for _ in range(20):
        k, dims = draw.integers(1, 20), draw.integers(1, 64)
        x, c = draw.integers(-span, span, (70, dims)), draw.integers(-span, span, (k, dims))
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        cluster, distance = centroids.nearest(x, c)
        assert (cluster == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
