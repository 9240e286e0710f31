import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from sparkfold.llm import merkle
from sparkfold.llm.queries import QUERIES

KEYS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(x):
    return sha256(x.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, at):
    for level in tree[:-1]:
        start = at // 3 * 3
        yield "".join(level[start:at]), "".join(level[at + 1 : start + 3])
        at //= 3


def brute(rows, tamper):
    groups = {}
    for r in rows:
        changed = leaf((*r[:4], tamper(r)))
        groups.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, leaf(r)), r[0], leaf(r), changed))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (_, doc, own, changed) in enumerate(sorted(groups[s])):
            path = [*way(trees[s], at), *way(top, k)]
            folded = changed
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((doc, own, trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), folded))
    return sorted(out, key=str)


def found(df):
    names = ["doc_id", "leaf", "subroot", "root", "siblings", "folded_root"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def strip(r):
    hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
    return r[4].replace("\n", "") if hit and r[4] is not None else r[4]


def tampered():
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def hostile():
    draw = random.Random(4)
    rows = [(i, "hot", "en", i, f"line {i}\nnext") for i in range(100)]
    rows += [(draw.randrange(10**6), f"s{draw.randrange(40)}", "de", 3, "é\n\n") for _ in range(60)]
    rows += [(7, None, None, None, None), (8, None, "", 0, ""), (None, "hot", "en", 1, "a\nb"), (9, "", "x", 1, "ü")]
    rows += [(None, None, None, None, None)] * 2 + [(3, "hot", "en", 3, "line 3\nnext"), (3, "hot", "fr", 3, "other")]
    return rows + [(-5, "alone", "en", 10**6, "long\n" * 200_000), (2**60, "\U0001f600", "en", 1, "|")]


@pytest.mark.parametrize("height", [1, 2, 7])
def test_against_brute_force(spark, height):
    schema = "doc_id long, source string, lang string, n_chars int, text string, leaf string, grp int"
    df = spark.createDataFrame([(*r, "clash", 1) for r in hostile()], schema)
    assert found(merkle.verify(df, tampered(), height=height)) == brute(hostile(), strip)


def test_copied_paths(spark):
    rows = [(i, "s", "en", 1, "a\nb" if i < 5 else "ab") for i in range(30)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} {t}" for k, t in zip(KEYS, ["long", "string", "string", "int", "string"])))
    out = {r.doc_id: r for r in merkle.verify(df, tampered(), height=2).collect()}
    for i, r in out.items():
        if strip(rows[i]) == rows[i][4]:
            assert r.copied is None and r.folded_root == r.root
        else:
            # the leaf, three levels of 10, 4 and 2 nodes, and the root
            assert len(r.copied) == 5 and r.copied[-1] == r.folded_root != r.root
    assert merkle.verify(df.limit(0), tampered()).count() == 0
    one = merkle.verify(df.limit(1)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.siblings == sha("")


def test_ranks_in_buckets(spark):
    draw = random.Random(9)
    ids = [draw.choice([5, None, *range(300)]) for _ in range(900)]
    rows = [(d, f"g{i % 2}", sha(str(i // 3)), None) for i, d in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, grp string, leaf string, changed string")
    got = merkle.ranked(df, bucket_rows=40).collect()
    for g in ("g0", "g1"):
        want = sorted([(d is not None, d or 0, h) for d, x, h, _ in rows if x == g])
        mine = sorted((r.pos, r.n, r.doc_id, r.leaf) for r in got if r.grp == g)
        assert [p for p, *_ in mine] == list(range(len(want))) and {n for _, n, *_ in mine} == {len(want)}
        assert [(d is not None, d or 0, h) for _, _, d, h in mine] == want


def test_many_groups(spark):
    names = [f"https://host{i}.é/" for i in range(500)] + ["-", "=a"]
    df = spark.createDataFrame([(n, "x") for n in names], "grp string, node string")
    got = merkle._ranked_names(df, run_rows=30).collect()
    assert [r.name for r in sorted(got, key=lambda r: r.pos)] == sorted(names, key=str.encode)
    assert {r.n for r in got} == {502}


def test_query_against_brute_force(spark, data):
    rows = [tuple(r[k] for k in KEYS) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = QUERIES["op13_merkle_manifest"](spark, data).withColumnRenamed("proof_sha256", "siblings")
    assert found(got) == brute(rows, strip)
    assert {r.verified for r in got.collect()} == {True, False}
