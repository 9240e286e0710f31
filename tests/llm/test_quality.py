import math
import re
import zlib

import pytest

from sparkfold.llm import quality
from sparkfold.llm.queries import QUERIES

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = GAP.findall(text)
    lines = [x for x in text.split("\n") if GAP.search(x)]
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (
        len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed
    )


def codes(text, size):
    c = [zlib.crc32(w.encode()) for w in GAP.findall(text or "")]
    return [x % size for x in c] + [(x * quality.PAIR + y) % size for x, y in zip(c, c[1:])]


def brute(docs, trusted, size=10_000, loss=0.005):
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    raw, good = [0] * size, [0] * size
    for d, text in docs:
        for b in codes(text, size):
            raw[b] += 1
            good[b] += d in trusted and not held(d)
    ratio = quality.log_ratios(good, raw, 1.0)
    score, fails = {}, {}
    for d, text in docs:
        found = codes(text, size)
        score[d] = math.floor(sum(ratio[b] for b in found) / len(found)) if found else 0
        fails[d] = base(text)[-1]
    bins = sorted(score[d] // 1000 for d in trusted if d in score and held(d) and not fails[d])
    at = bins[int(loss * len(bins))] * 1000 if bins else 0
    return {d: (*base(t), score[d], not fails[d] and score[d] >= at) for d, t in docs}


def found(result):
    return {
        r.doc_id: (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
            r.score_micro, r.kept,
        )
        for r in result.collect()
    }


def test_against_brute_force(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{data}/labels.parquet").where("quality = 1").collect()
    result = QUERIES["op1_quality_rules"](spark, data)
    assert found(result) == brute(docs, {r.doc_id for r in labels})


def test_edges(spark):
    line = "a b c d e f g h i j"
    texts = [None, "", " \n\t", "x" * 50_000, f"{line}\n{line}\n{line}", "é# ü\u00a0z", "a " * 30]
    docs = spark.createDataFrame(
        [(i, t, 1) for i, t in enumerate(texts)] + [(None, "a b", 1)] * 2,
        "doc_id long, text string, kept int",
    )
    rows = quality.quality_rules(docs, spark.createDataFrame([(4,), (None,)], "doc_id long"))
    got = {r.doc_id: r for r in rows.collect()}
    assert rows.count() == 9
    for i, t in enumerate(texts):
        assert tuple(got[i][1:7]) == tuple(got[i].asDict()[k] for k in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
        ))
        assert found(rows.where(f"doc_id = {i}"))[i][:6] == base(t)
    assert quality.quality_rules(docs.limit(0), docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 5, 8])
def test_ngram_hashes_tell_runs_apart(spark, n):
    from sparkfold.llm.common import ngram_hashes

    df = spark.createDataFrame([([1, 2, 3] * 4 + [9],), ([1],), ([],)], "c array<long>")
    rows = [r.h for r in ngram_hashes(df, "c", n, "h").collect()]
    runs = [tuple(([1, 2, 3] * 4 + [9])[i : i + n]) for i in range(14 - n)]
    assert len(rows[0]) == len(runs) and len(set(rows[0])) == len(set(runs))
    assert rows[1] == [] and rows[2] == []
