import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkfold.llm import decontaminate as dc


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs, items, threshold=0.8):
    best = {}
    for d, text in docs:
        w = (text or "").split()
        for i, said in items:
            x = (said or "").split()
            if len(w) < 5 or len(x) < 5:
                continue
            want, size = shingles(x), min(len(x), len(w))
            for a in range(len(w) - size + 1):
                have = shingles(w[a : a + size])
                s = sum((have & want).values()) / sum((have | want).values())
                if s >= threshold - 1e-9:
                    best[d, i] = max(best.get((d, i), (0, 0)), (round(s, 6), -a))
    return sorted((*k, s, -a) for k, (s, a) in best.items())


def found(df):
    return sorted((r.doc_id, r.item_id, r.similarity, r.start_word) for r in df.collect())


def test_against_brute_force(spark):
    draw = random.Random(11)
    word = lambda n: [f"w{draw.randrange(300)}" for _ in range(n)]
    items = [(i, " ".join(word(draw.randrange(5, 70)))) for i in range(25)]
    items += [(30, items[3][1]), (31, "too few words here"), (32, None), (33, ""), (34, "z " * 40)]
    docs = []
    for d in range(120):
        w = word(draw.randrange(0, 60))
        for _ in range(draw.randrange(3)):
            part = items[draw.randrange(25)][1].split()
            if draw.random() < 0.5:
                part = part[draw.randrange(4) : len(part) - draw.randrange(4)]
            if part and draw.random() < 0.3:
                part[draw.randrange(len(part))] = "changed"
            w += part + word(draw.randrange(30))
        docs.append((d, " ".join(w)))
    docs += [(200, None), (201, ""), (202, "z " * 8_000), (203, "z " * 34), (204, items[1][1])]
    docs += [docs[-1], (-1, items[2][1] + " x " + items[2][1])]
    left = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, size int")
    right = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, key int")
    assert found(dc.contamination(left, right)) == brute(docs, items)
    assert dc.contamination(left.limit(0), right).count() == 0
    assert dc.contamination(left, right.limit(0)).count() == 0
    unnamed = left.where("doc_id = 204").withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.doc_id for r in dc.contamination(unnamed, right).collect()] == [None]


@pytest.mark.parametrize("radius", [0, 3, 20])
def test_blocks_find_all_within_radius(spark, radius):
    draw = random.Random(radius)
    rows = []
    for _ in range(200):
        a, b = draw.getrandbits(64), 0
        for bit in draw.sample(range(64), radius):
            b |= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, a ^ b)))
    df = spark.createDataFrame(rows, "a long, b long")
    both = F.array_intersect(dc.blocks("a", radius), dc.blocks("b", radius))
    assert df.where(F.size(both) == 0).count() == 0


def test_fingerprint_is_the_majority(spark):
    draw = random.Random(1)
    codes = [[draw.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 7, 300)]
    df = spark.createDataFrame([(c,) for c in codes], "h array<long>")
    for row, c in zip(df.select(dc.fingerprint("h").alias("f")).collect(), codes):
        bits = [sum(x >> k & 1 for x in c) * 2 > len(c) for k in range(64)]
        assert row.f % (1 << 64) == sum(1 << k for k, b in enumerate(bits) if b)


def test_repeated_shingles_at_the_threshold(spark):
    draw = random.Random(7)
    word = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    items, docs = [], []
    for k in range(16):
        # 80 shingles in common; the item has ten times the same one, the document ten others
        part = word(80)
        items.append((k, " ".join(part + ["z"] * 14)))
        docs.append((k, " ".join(part + ["z"] * 4 + word(10))))
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert [(d, i, s) for d, i, s, _ in want] == [(k, k, 0.8) for k in range(16)]
    got = found(dc.contamination(left, right))
    # the first of these pairs differs in 21 bits, beyond the radius, as few pairs do
    assert set(got) <= set(want) and len(got) >= 15
    codes = spark.createDataFrame([([5, 3, 5, 5, 3],), ([1, 2],)], "h array<long>")
    one, two = [r.s for r in codes.select(dc.numbered("h").alias("s")).collect()]
    assert len(one) == len(set(one)) == 5 and {3, 5} < set(one) and two == [1, 2]
