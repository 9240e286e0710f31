"""The registered query of each operator: whole tables in, one digest row per id out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.llm import (
    centroids, chat, decontaminate, jaccard_join, line_dedup, merkle, minhash, pieces, pii, quality,
    suffix_repeats, toxicity, warc,
)
from sparkfold.llm.common import load
from sparkfold.runtime import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = load(spark, folder, "labels").where("quality = 1")
    return quality.quality_rules(load(spark, folder, "documents"), trusted)


@query
def op2_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, key="surrogates of the registered query")


@query
def op3_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(load(spark, folder, "pages"), path)
    found = warc.read_archives(spark, path, payloads=False).where("kind = 'record'")
    return found.select(
        F.expr("CAST(nullif(record_id, 'none') AS BIGINT)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        load(spark, folder, "documents"), load(spark, folder, "benchmark")
    )


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(load(spark, folder, "documents"))


def held_out(doc_id: str = "doc_id"):
    """Documents whose labels nothing may be learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    labels = load(spark, folder, "labels").where(~held_out())
    model = toxicity.fit(docs.where(~held_out()), labels)
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = suffix_repeats.without_repeats(load(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return left.select(
        "doc_id",
        (F.octet_length("data") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("data", 256).alias("kept_sha256"),
    )


@query
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = load(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(rows.union(extra))


@query
def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_texts(load(spark, folder, "documents"), model)
    return pieces.decode_ids(coded, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(load(spark, folder, "documents"))


@query
def op11_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(load(spark, folder, "documents"))


@query
def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load(spark, folder, "embeddings")
    found, centres = centroids.cluster(vectors, "vec_id", "embedding", dims=64, k=16, rounds=3)
    return centroids.with_inertia(found, centres).withColumnRenamed("id", "vec_id")


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verify(docs, tampered).select(
        "doc_id", "leaf", "subroot", "root", F.col("siblings").alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ORACLE["op8_chat_format"] = r"""
WITH r AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (
    SELECT 's>|/s>|INST:|INST\]|/INST\]|<SYS>>|</SYS>>' AS tails),
e AS (
    SELECT r.*, regexp_replace(text, '([<\[])(\\*)(' || tails || ')', '\1\\\2\3', 'g') AS t,
           regexp_replace(role, '([<\[])(\\*)(' || tails || ')', '\1\\\2\3', 'g') AS o
    FROM r, c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
           FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(16 + length(o) + length(t)) AS BIGINT) AS formatted_chars,
       CAST(sum(CAST(o <> role OR t <> text AS INTEGER)) AS BIGINT) AS n_escaped
FROM e GROUP BY conv_id
"""

ORACLE["op10_jaccard_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM w, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 3))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
    SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
r AS (
    SELECT doc_id, doc_id AS class_id FROM documents
    UNION SELECT l.b, r.class_id FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(class_id) AS class_id FROM r GROUP BY doc_id),
k AS (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM m LEFT JOIN k USING (doc_id)
"""

# every window that shares a shingle with an item, compared with it by counted shingles
ORACLE["op4_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (
    SELECT item_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (
    SELECT doc_id, p, array_to_string(w[p + 1:p + 5], ' ') AS s, len(w) AS n
    FROM d, LATERAL (SELECT unnest(range(0, len(w) - 4)) AS p)),
it AS (
    SELECT item_id, len(w) AS n, array_to_string(w[p + 1:p + 5], ' ') AS s
    FROM i, LATERAL (SELECT unnest(range(0, len(w) - 4)) AS p)),
ic AS (SELECT item_id, n, s, count(*) AS c FROM it GROUP BY ALL),
hit AS (
    SELECT ds.doc_id, ds.p, ds.n, ic.item_id, ic.n AS len FROM ds JOIN ic ON ds.s = ic.s),
win AS (
    SELECT DISTINCT doc_id, item_id, least(len, n) - 4 AS width, len - 4 AS size, a
    FROM hit, LATERAL (SELECT unnest(range(greatest(0, p - least(len, n) + 5),
                                           least(p, n - least(len, n)) + 1)) AS a)),
inside AS (
    SELECT win.doc_id, win.item_id, width, size, a, ds.s, count(*) AS c
    FROM win JOIN ds ON ds.doc_id = win.doc_id AND ds.p BETWEEN a AND a + width - 1
    GROUP BY ALL),
common AS (
    SELECT doc_id, x.item_id, width, size, a, sum(least(x.c, ic.c)) AS m
    FROM inside x JOIN ic ON ic.item_id = x.item_id AND ic.s = x.s GROUP BY ALL),
sim AS (
    SELECT doc_id, item_id, a, CAST(m AS DOUBLE) / (width + size - m) AS v FROM common)
SELECT doc_id, item_id, round(max(v), 6) AS similarity,
       CAST(min(a) FILTER (v = best) AS BIGINT) AS start_word
FROM (SELECT *, max(v) OVER (PARTITION BY doc_id, item_id) AS best FROM sim)
WHERE best >= 0.8 - 1e-9 GROUP BY doc_id, item_id
"""

ORACLE["op11_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
    FROM w, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 1))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
    SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (
    SELECT doc_id, doc_id AS component_id FROM documents
    UNION SELECT l.b, r.component_id FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(component_id) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)
"""


def _centroid_sql(k: int, rounds: int) -> str:
    """Every vector against every centroid, once per round and once more."""
    parts = [
        f"""WITH kept AS MATERIALIZED (
    SELECT vec_id, embedding AS e FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
v AS MATERIALIZED (
    SELECT vec_id, d, CAST(floor(64 * CAST(e[d] AS DOUBLE)) AS BIGINT) AS x
    FROM kept, LATERAL (SELECT unnest(range(1, 65)) AS d)),
f AS (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT c, d, x FROM v JOIN f USING (vec_id) WHERE c < {k})"""
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
    SELECT vec_id, arg_min(c, q * {k} + c) AS c, min(q) AS q FROM (
        SELECT vec_id, c.c, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS q
        FROM v JOIN c{r} c USING (d) GROUP BY vec_id, c.c) GROUP BY vec_id)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
    SELECT c.c, c.d, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{r} c LEFT JOIN (
        SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
        FROM v JOIN a{r} USING (vec_id) GROUP BY c, d) m ON m.c = c.c AND m.d = c.d)"""
            )
    parts.append(
        f"""h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c),
i AS (SELECT c, CAST(sum(q) AS BIGINT) AS i FROM a{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, q AS distance, i AS cluster_inertia,
       (SELECT CAST(sum(q) AS BIGINT) FROM a{rounds}) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN h USING (c) JOIN i USING (c)"""
    )
    return ",\n".join(parts)


ORACLE["op12_centroid_clusters"] = _centroid_sql(16, 3)

# crc32 takes eight steps a byte: the byte is added before the first of them
ORACLE["op13_merkle_manifest"] = r"""
WITH RECURSIVE f AS (
    SELECT doc_id, coalesce('=' || source, '-') AS g, text,
           concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                  coalesce(strlen(source) || ':' || source, '-'),
                  coalesce(strlen(lang) || ':' || lang, '-'),
                  coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
           list_reduce(
               flatten([[ascii((doc_id::VARCHAR)[i]), 0, 0, 0, 0, 0, 0, 0]
                        FOR i IN range(1, length(doc_id::VARCHAR) + 1)]),
               lambda a, e: xor(xor(a, e::BIGINT) >> 1, (xor(a, e::BIGINT) & 1) * 3988292384),
               4294967295::BIGINT) AS crc
    FROM documents),
b AS (
    SELECT *, CASE WHEN crc % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS bad FROM f),
d AS MATERIALIZED (
    SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(bad) || ':' || bad, '-')) AS changed,
           row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n
    FROM b),
t AS (
    SELECT g, 0 AS lvl, pos, n, leaf AS h FROM d
    UNION ALL
    SELECT g, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
    FROM t WHERE n > 1 GROUP BY g, lvl, n, pos // 3),
o AS MATERIALIZED (
    SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
    SELECT 0 AS lvl, pos, n, h FROM o
    UNION ALL
    SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
    FROM u WHERE n > 1 GROUP BY lvl, n, pos // 3),
s AS MATERIALIZED (
    SELECT x.g, x.lvl, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
           coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
    FROM t x JOIN t y ON x.g = y.g AND x.lvl = y.lvl AND x.pos // 3 = y.pos // 3
    WHERE x.n > 1 GROUP BY ALL
    UNION ALL
    SELECT '', x.lvl, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), ''),
           coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '')
    FROM u x JOIN u y ON x.lvl = y.lvl AND x.pos // 3 = y.pos // 3
    WHERE x.n > 1 GROUP BY ALL),
p AS (
    SELECT g AS own, pos AS place, g, 0 AS lvl, pos, n, changed AS h, '' AS proof FROM d
    UNION ALL
    SELECT own, place, p.g, p.lvl + 1, p.pos // 3, (n + 2) // 3, sha256(l || h || r), proof || l || r
    FROM p JOIN s ON s.g = p.g AND s.lvl = p.lvl AND s.pos = p.pos WHERE n > 1),
q AS (
    SELECT own, place, 0 AS lvl, o.pos, o.n, p.h, proof FROM p JOIN o ON o.g = own WHERE p.n = 1
    UNION ALL
    SELECT own, place, q.lvl + 1, q.pos // 3, (n + 2) // 3, sha256(l || h || r), proof || l || r
    FROM q JOIN s ON s.g = '' AND s.lvl = q.lvl AND s.pos = q.pos WHERE n > 1)
SELECT doc_id, leaf, o.h AS subroot, u.h AS root, sha256(proof) AS proof_sha256, q.h AS folded_root,
       q.h = u.h AS verified
FROM q JOIN d ON d.g = own AND d.pos = place JOIN o ON o.g = own JOIN u ON u.n = 1 WHERE q.n = 1
"""
