"""Exact substring dedup by an enhanced suffix array of anchored contexts.

Two texts that share 50 bytes share the 16-byte gram of least hash among them, the anchor. Each
50-byte window belongs to one anchor, so windows can be compared anchor by anchor:

1. anchors are brought together by hash to learn which occur in several documents;
2. for those only, the context (all windows of the anchor) is sent to the anchor's part;
3. each part builds the suffix array of its contexts with the common prefix lengths of neighbours,
   scans it with a stack for the common-prefix intervals of at least 50 bytes, and keeps those
   whose occurrences have different bytes on the left: the maximal repeats, with all occurrences;
4. an occurrence in a document with a larger id than another one of the group is removed.

Whole copies are found by digest and stay out. A task resolves what repeats among its own documents
before anything is sent, so a passage that a third of all documents hold sends one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkfold.llm.common import join_few, kept_table
from sparkfold.llm.shingles import mix, runs_of

#: Length of the shortest repeat, of a gram, and grams per window.
LEAST, GRAM = 50, 16
GRAMS = LEAST - GRAM + 1
#: Bytes of text that a task looks at together, and positions hashed at a time.
BATCH, STEP = 8 << 20, 1 << 20
#: Bytes of text per part of the anchors and of the contexts.
ANCHOR_PART, CONTEXT_PART = 32 << 20, 8 << 20
#: Bytes of contexts that a part sorts at a time, whole anchors at least.
SLICE = 1 << 20
#: Stands for the id of rows without one: smaller than all others.
NO_ID = -(1 << 63)
_POSITION = np.uint64((1 << 24) - 1)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _grams(data: np.ndarray) -> np.ndarray:
    """64-bit hash of every run of GRAM bytes, by doubling."""
    h = _TABLE[data]
    width = 1
    while width < GRAM:
        factor = np.uint64(0x9E3779B97F4A7C15 + 2 * width)
        h = h[:-width] * factor + h[width:]
        h ^= h >> np.uint64(29)
        width *= 2
    return mix(h)


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the documents that end at `ends`: hash, place, first and last window of each.

    A window is a start of LEAST bytes inside one document; its anchor is the gram of least hash in
    it, the leftmost of equal ones. Windows of an anchor follow each other.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for c in range(0, max(0, len(data) - LEAST + 1), STEP):
        h = _grams(data[c : c + STEP + LEAST - 1])
        low = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width * 2 <= GRAMS:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (GRAMS - width)], low[GRAMS - width :])
        place = (low & _POSITION).astype(np.int64)
        inside = np.ones(len(place), dtype=bool)
        for e in ends[(ends > c) & (ends <= c + len(place) + LEAST)]:
            inside[max(0, e - c - LEAST + 1) : max(0, e - c)] = False
        new = inside.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
        last = inside.copy()
        last[:-1] &= (place[1:] != place[:-1]) | ~inside[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(last)
        at = place[first]
        found.append((h[at], at + c, first + c, last + c))
    if not found:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            yield from batch.slice(start, 64).to_pylist()


def _batches_of(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Rows in lists of about BATCH bytes of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["data"])
        if size >= BATCH:
            yield held
            held, size = [], 0
    if held:
        yield held


def _joined(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all rows, where each ends, and the ids of their texts."""
    data = np.frombuffer(b"".join(r["data"] for r in rows), dtype=np.uint8)
    ends = np.cumsum([len(r["data"]) for r in rows])
    return data, ends, np.array([r["id"] for r in rows], dtype=np.int64)


PARTED = "part long, kind int, id long, blob binary"
_PARTED = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("id", pa.int64()), ("blob", pa.binary())])
BUCKETED = "bucket long, kind int, id long, blob binary"
_BUCKETED = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("id", pa.int64()), ("blob", pa.binary())])


def _by_id(ids: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    cuts = np.flatnonzero(np.diff(ids)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(ids)]):
        if a < b:
            yield int(ids[a]), tuple(x[order[a:b]] for x in arrays)


def _send_anchors(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches_of(_rows_of(batches)):
            data, ends, ids = _joined(rows)
            h, at, _, _ = anchors(data, ends)
            doc = np.searchsorted(ends, at, side="right")
            begin = np.concatenate([[0], ends[:-1]])
            at, owner = (at - begin[doc]).astype(np.uint32), ids[doc]
            # grouped by hash: what two documents of this task share is known already
            order = np.argsort(h, kind="stable")
            h, at, owner = h[order], at[order], owner[order]
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
            if not len(start):
                continue
            size = np.diff(np.append(start, len(h)))
            several = np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)
            known = np.repeat(several, size)
            out = [
                {"part": k % parts, "kind": 1, "id": k, "blob": _pack(p)}
                for k, (p,) in _by_id(owner[known], at[known])
            ]
            # of a known one a single row goes on, marked, for the other tasks
            ask = ~known
            ask[start[several]] = True
            h, at, owner, known = h[ask], at[ask], owner[ask], known[ask]
            part = (h % np.uint64(parts)).astype(np.int64)
            code = (h >> np.uint64(16)) << np.uint64(1) | known.astype(np.uint64)
            for k, (c, o, p) in _by_id(part, code, owner, at):
                six = c.view(np.uint8).reshape(-1, 8)[:, :7]
                place = np.lexsort((p, o))
                blob = _pack(np.ascontiguousarray(six[place]), o[place], p[place])
                out.append({"part": k, "kind": 0, "id": len(c), "blob": blob})
            yield pa.RecordBatch.from_pylist(out, _PARTED)

    return run


def _bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _bundled(buckets: int, ids: list[np.ndarray], *columns: list[np.ndarray]) -> pa.RecordBatch:
    """What belongs to documents, packed by bucket of their id: a row per bucket, not per document."""
    all_ids = np.concatenate(ids)
    values = [np.concatenate(c) for c in columns]
    out = [
        {"bucket": k, "kind": 0, "id": len(part[0]), "blob": _pack(*part)}
        for k, part in _by_id(_bucket_of(all_ids, buckets), all_ids, *values)
    ]
    return pa.RecordBatch.from_pylist(out, _BUCKETED)


def _shared_anchors(buckets: int):
    """Bundles (id, place) of the anchors that occur in several documents, part by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, ["part"]):
            ids, at, codes, owners, places = [], [], [], [], []
            for row in group.to_pylist():
                raw = _unpack(row["blob"])
                if row["kind"] == 1:
                    at.append(np.frombuffer(raw, np.uint32))
                    ids.append(np.full(len(at[-1]), row["id"], dtype=np.int64))
                    continue
                n = row["id"]
                wide = np.zeros((n, 8), dtype=np.uint8)
                wide[:, :7] = np.frombuffer(raw, np.uint8, n * 7).reshape(n, 7)
                codes.append(wide.view(np.uint64).ravel())
                owners.append(np.frombuffer(raw, np.int64, n, n * 7))
                places.append(np.frombuffer(raw, np.uint32, n, n * 15))
            if codes:
                code, owner, place = map(np.concatenate, (codes, owners, places))
                order = np.argsort(code, kind="stable")
                code, owner, place = code[order], owner[order], place[order]
                known, code = code & np.uint64(1) == 1, code >> np.uint64(1)
                start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                size = np.diff(np.append(start, len(code)))
                several = np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)
                several |= np.logical_or.reduceat(known, start)
                tell = np.repeat(several, size) & ~known
                ids.append(owner[tell])
                at.append(place[tell])
            if ids:
                yield _bundled(buckets, ids, at)

    return run


def _beside(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[dict, list]]:
    """Rows of documents with what the bundles of their bucket hold for them.

    Rows come sorted by bucket and kind, bundles (kind 0) before documents: the arrays of one
    bucket are in memory at a time. A bundle has ids and `width` arrays of 32-bit numbers.
    """
    bucket, held = None, {}
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            for row in batch.slice(start, 64).to_pylist():
                if row["bucket"] != bucket:
                    bucket, held = row["bucket"], {}
                if row["kind"] == 1:
                    yield row, held.get(row["id"], [])
                    continue
                n, raw = row["id"], _unpack(row["blob"])
                columns = [np.frombuffer(raw, np.uint32, n, n * (8 + 4 * c)) for c in range(width)]
                for k, part in _by_id(np.frombuffer(raw, np.int64, n), *columns):
                    held.setdefault(k, []).append(part)


def _send_contexts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches_of(_inflated(batches)):
            data, ends, ids = _joined(rows)
            h, at, first, last = anchors(data, ends)
            begin = np.concatenate([[0], ends[:-1]])
            shared = np.concatenate(
                [p.astype(np.int64) + s for r, s in zip(rows, begin) for (p,) in r["places"]]
            )
            take = np.isin(at, shared)
            h, first, last = h[take], first[take], last[take]
            doc = np.searchsorted(ends, first, side="right")
            start, owner = first - begin[doc], ids[doc]
            order = np.array([r["order_"] for r in rows], dtype=np.int64)[doc]
            raw = data.tobytes()
            # equal contexts of this task: the least document asks, the others are repeats of it
            seen: dict[bytes, tuple[int, list[tuple[int, int]], int]] = {}
            done_id, done_from, done_to = [], [], []
            spans = zip(first.tolist(), last.tolist(), start.tolist())
            for key, (a, b, s), o, u in zip(h.tolist(), spans, order.tolist(), owner.tolist()):
                context = raw[a : b + LEAST]
                known = seen.get(context)
                if known is None:
                    seen[context] = (o, [(u, s)], key)
                elif o == known[0]:
                    known[1].append((u, s))
                else:
                    again = [(u, s)]
                    if o < known[0]:
                        seen[context] = (o, again, key)
                        again = known[1]
                    for text, x in again:
                        done_id.append(text)
                        done_from.append(x)
                        done_to.append(x + len(context))
            out = [
                {"part": k % parts, "kind": 1, "id": k, "blob": _pack(f, t)}
                for k, (f, t) in _by_id(
                    np.array(done_id, dtype=np.int64), np.array(done_from, np.uint32), np.array(done_to, np.uint32)
                )
            ]
            by_part: dict[int, list] = {}
            for context, (o, starts, key) in seen.items():
                for u, s in starts:
                    by_part.setdefault(key % parts, []).append((key, o, u ^ o, s, context))
            for k, entries in by_part.items():
                blob = _pack(
                    np.array([e[0] for e in entries], dtype=np.uint64),
                    np.array([e[1] for e in entries], dtype=np.int64),
                    np.array([e[2] for e in entries], dtype=np.int64),
                    np.array([e[3] for e in entries], dtype=np.uint32),
                    np.array([len(e[4]) for e in entries], dtype=np.uint32),
                    np.frombuffer(b"".join(e[4] for e in entries), dtype=np.uint8),
                )
                out.append({"part": k, "kind": 0, "id": len(entries), "blob": blob})
            if out:
                yield pa.RecordBatch.from_pylist(out, _PARTED)

    return run


def _inflated(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Documents that hold shared anchors, with their places."""
    for row, places in _beside(batches, 1):
        if places:
            yield {"id": row["id"], "order_": row["order_"], "data": _unpack(row["blob"]), "places": places}


def maximal_repeats(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """Maximal repeats of at least LEAST bytes in contexts: (length, places in data) per group.

    The contexts are data[start : start + length]. Their suffixes of at least LEAST bytes are sorted,
    neighbours give the common prefix lengths, and a stack turns these into the intervals of the
    common-prefix tree, deepest first. An interval is reported if the bytes before its suffixes
    differ, or one of them begins its context; else all of them extend to the left and a longer
    repeat covers them. Every group has all its occurrences.
    """
    count = np.maximum(lengths - LEAST + 1, 0)
    owner = np.repeat(np.arange(len(starts)), count)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = starts[owner] + offset
    if len(at) < 2:
        return
    # bytes are shifted by one, so that zero can stand for the end; no UTF-8 byte is 255
    shifted = np.append(data + np.uint8(1), np.zeros(LEAST, dtype=np.uint8))
    heads = np.lib.stride_tricks.sliding_window_view(shifted, LEAST)[at].view(f"S{LEAST}").ravel()
    order = np.argsort(heads, kind="stable")
    heads = heads[order]
    same = heads[1:] == heads[:-1]
    inside = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    order = order[inside]
    if not len(order):
        return
    at, room = at[order], (lengths[owner] - offset)[order]
    edge = (offset == 0)[order]
    # the suffixes that share LEAST bytes with another one, sorted over their whole length
    most = int(room.max())
    tails = np.append(data + np.uint8(1), np.zeros(most, dtype=np.uint8))
    tails = np.lib.stride_tricks.sliding_window_view(tails, most)[at].copy()
    tails[np.arange(most)[None, :] >= room[:, None]] = 0
    order = np.argsort(tails.view(f"S{most}").ravel(), kind="stable")
    at, room, edge, tails = at[order], room[order], edge[order], tails[order]
    differ = (tails[1:] != tails[:-1]) | (tails[1:] == 0)
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
    before = np.where(edge, -1, data[at - 1].astype(np.int64))
    lcp, left = common.tolist() + [0], before.tolist()
    # stack of open intervals: depth, first suffix, byte on the left (-1 if they differ)
    stack: list[list[int]] = []
    for i, depth in enumerate(lcp):
        mark, low = left[i], i
        while stack and stack[-1][0] > depth:
            open_depth, low, seen = stack.pop()
            mark = seen if seen == mark else -1
            if mark == -1:
                yield open_depth, at[low : i + 1]
            if stack and stack[-1][0] >= depth:
                if stack[-1][2] != mark:
                    stack[-1][2] = -1
                mark = stack[-1][2]
        if depth >= LEAST:
            if stack and stack[-1][0] == depth:
                if stack[-1][2] != mark:
                    stack[-1][2] = -1
            else:
                stack.append([depth, low, mark])


def _repeated_ranges(buckets: int):
    """Bundles (id, from, to) of the bytes to remove, part by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, ["part"]):
            parts, ids, low, high = [], [], [], []
            for row in group.to_pylist():
                n, raw = row["id"], _unpack(row["blob"])
                if row["kind"] == 1:
                    flat = np.frombuffer(raw, np.uint32)
                    low.append(flat[: len(flat) // 2])
                    high.append(flat[len(flat) // 2 :])
                    ids.append(np.full(len(low[-1]), n, dtype=np.int64))
                    continue
                lengths = np.frombuffer(raw, np.uint32, n, n * 28)
                ends = n * 32 + np.cumsum(lengths, dtype=np.int64)
                order = np.frombuffer(raw, np.int64, n, n * 8)
                parts += zip(
                    np.frombuffer(raw, np.uint64, n).tolist(),
                    order.tolist(),
                    (np.frombuffer(raw, np.int64, n, n * 16) ^ order).tolist(),
                    np.frombuffer(raw, np.uint32, n, n * 24).tolist(),
                    (raw[e - s : e] for s, e in zip(lengths.tolist(), ends.tolist())),
                )
            parts.sort(key=lambda e: e[0])
            i = 0
            while i < len(parts):
                # whole anchors, up to SLICE bytes
                j, size = i, 0
                while j < len(parts) and (size < SLICE or parts[j][0] == parts[j - 1][0]):
                    size += len(parts[j][4])
                    j += 1
                found = list(_resolve(parts[i:j]))
                ids.append(np.array([x[0] for x in found], dtype=np.int64))
                low.append(np.array([x[1] for x in found], dtype=np.uint32))
                high.append(np.array([x[2] for x in found], dtype=np.uint32))
                i = j
            if ids:
                yield _bundled(buckets, ids, low, high)

    return run


def _resolve(entries: list[tuple]) -> Iterator[tuple[int, int, int]]:
    """(id, from, to) to remove, of contexts (anchor, order, id, start, bytes) with whole anchors."""
    distinct: dict[bytes, list[tuple[int, int, int]]] = {}
    for _, o, u, s, context in entries:
        distinct.setdefault(context, []).append((o, u, s))
    contexts, owners = list(distinct), [min(o for o, _, _ in x) for x in distinct.values()]
    for context, least in zip(contexts, owners):
        for o, u, s in distinct[context]:
            if o > least:
                yield u, s, s + len(context)
    if len(contexts) < 2:
        return
    lengths = np.array([len(c) for c in contexts], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    owner = np.array(owners, dtype=np.int64)
    for length, places in maximal_repeats(data, starts, lengths):
        which = np.searchsorted(starts, places, side="right") - 1
        least = owner[which].min()
        for w, p in zip(which.tolist(), places.tolist()):
            if owner[w] > least:
                inside = p - int(starts[w])
                for o, u, s in distinct[contexts[w]]:
                    if o == owners[w]:
                        yield u, s + inside, s + inside + length


def _packed(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows (id, ..., data) as (bucket, kind 1, id, ..., blob): the compressed bytes of each text."""
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                pack = zstandard.ZstdCompressor(level=1)
                done = [pack.compress(x) for x in part.column("data").to_pylist()]
                ids = part.column("id").fill_null(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_bucket_of(ids, buckets)),
                        pa.array(np.ones(len(done), dtype=np.int32)),
                        *[part.column(c) for c in names],
                        pa.array(done, pa.binary()),
                    ],
                    ["bucket", "kind", *names, "blob"],
                )

    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"bucket long, kind int, {kinds}, blob binary")


def _gathered(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a part next to each other, in as many tasks as the session shuffles to."""
    return rows.repartition(keys[0]).sortWithinPartitions(*keys)


def repeated_bytes(docs: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Bundles of the ranges to remove from texts (id, order_, data), and the number of buckets.

    A byte is in a range if some 50 bytes that cover it also start in a text of a smaller order_;
    the id names the text.
    ``total`` is the size of all texts in bytes; it sets the number of parts.
    """
    few = -(-total // ANCHOR_PART) or 1
    many = -(-total // CONTEXT_PART) or 1
    docs = docs.select("id", "order_", "data")
    sent = docs.mapInArrow(_send_anchors(few), PARTED)
    shared = _gathered(sent, "part").mapInArrow(_shared_anchors(few), BUCKETED)
    beside = _gathered(shared.unionByName(_packed(docs, few), allowMissingColumns=True), "bucket", "kind")
    contexts = beside.mapInArrow(_send_contexts(many), PARTED)
    return _gathered(contexts, "part").mapInArrow(_repeated_ranges(few), BUCKETED), few


def _spans(ranges: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Union of ranges as sorted runs that do not touch."""
    pairs = [p for low, high in ranges for p in zip(low.tolist(), high.tolist())]
    runs: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return runs


def _names(rows: DataFrame) -> DataFrame:
    """(order_, digest, name) of the texts that share an order_ with other texts: a number of their own.

    Names are hashes; they are drawn again until none is taken by another text.
    """
    ids = rows.groupBy("order_").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    shared = kept_table(ids.where("low <> high").select("order_"), "shared")
    if shared.isEmpty():
        return shared.selectExpr("order_", "CAST(NULL AS STRING) AS digest", "CAST(NULL AS BIGINT) AS name")
    texts = kept_table(join_few(rows.select("order_", "digest"), shared, "order_").distinct(), "clash")
    for seed in range(64):
        names = kept_table(texts.withColumn("name", F.xxhash64("order_", "digest", F.lit(seed))), "names")
        twice = names.groupBy("name").count().where("count > 1")
        taken = join_few(rows.select(F.col("order_").alias("name")), names.select("name"), "name", "left_semi")
        if twice.isEmpty() and taken.isEmpty():
            return names
    raise RuntimeError("no free names for texts that share a doc_id.")


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, data, spans) per row of docs (doc_id, text): what is left, and the runs removed.

    Removed is each byte of a text covered by a string of 50 bytes that also starts in a row with
    a smaller doc_id; matches never cross texts and are judged on the input. data is binary, for a
    cut may split a character; spans are pairs [from, to).

    NULL texts are empty, a NULL doc_id counts as smaller than all others, repeated rows do not
    remove each other's bytes, an empty table gives an empty result, other columns are ignored.
    Different texts under one doc_id all take part and do not remove each other's bytes.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("order_"),
        F.coalesce("text", F.lit("")).cast("binary").alias("data"),
    )
    rows = rows.withColumn("digest", F.sha2("data", 256))
    texts = rows.groupBy("digest").agg(F.min("order_").alias("least"), F.count("*").alias("n"))
    copies = kept_table(texts.where("n > 1").select("digest", "least"), "copies")
    marked = join_few(rows, copies, "digest", "left")
    marked = join_few(marked, _names(rows), ["order_", "digest"], "left")
    marked = marked.withColumn("id", F.coalesce("name", "order_"))
    original = (F.col("least").isNull()) | (F.col("least") == F.col("order_"))
    first = marked.where(original & (F.octet_length("data") >= LEAST))
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    ranges, buckets = repeated_bytes(first.select("id", "order_", "data"), total)
    packed = _packed(marked.select("id", "doc_id", (~original).alias("copy"), "data"), buckets)
    beside = _gathered(ranges.unionByName(packed, allowMissingColumns=True), "bucket", "kind")
    schema = pa.schema([("data", pa.binary()), ("spans", pa.list_(pa.list_(pa.int64())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, left, spans, size = [], [], [], 0
        for row, ranges in _beside(batches, 2):
            data = _unpack(row["blob"])
            if row["copy"]:
                runs = [(0, len(data))] if len(data) >= LEAST else []
            else:
                runs = _spans(ranges)
            kept, at = [], 0
            for a, b in runs:
                kept.append(data[at:a])
                at = b
            ids.append(row["doc_id"])
            left.append(b"".join([*kept, data[at:]]))
            spans.append([list(r) for r in runs])
            size += len(data)
            if size >= BATCH:
                yield out(ids, left, spans)
                ids, left, spans, size = [], [], [], 0
        if ids:
            yield out(ids, left, spans)

    def out(ids, left, spans) -> pa.RecordBatch:
        columns = [pa.array(left, schema[0].type), pa.array(spans, schema[1].type)]
        return pa.RecordBatch.from_arrays([pa.array(ids, arrow_kind), *columns], ["doc_id", "data", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    return beside.select("bucket", "kind", "id", "doc_id", "copy", "blob").mapInArrow(
        run, f"doc_id {kind}, data binary, spans array<array<long>>"
    )
