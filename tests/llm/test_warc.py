import base64
import gzip
import hashlib
import random
import time

from sparkfold.llm import warc
from sparkfold.llm.queries import QUERIES
from sparkfold.runtime import scratch_path


def whole(i, payload, **kw):
    return warc.record(str(i), f"http://x/{i}", payload, warc.digest(payload), kw.get("to")) + b"\r\n"


def ids(found):
    return [x.fields["warc-record-id"][10:-1] for x in found if isinstance(x, warc.Record)]


def covered(found, size):
    at = 0
    for x in found:
        assert x.offset == at
        at += x.length
    assert at == size


def test_damage_costs_only_the_damaged():
    records = [whole(i, b"<p>%d WARC/1.1\r\n</p>" % i * 20) for i in range(6)]
    data = bytearray(b"".join(records))
    at = len(records[0]) + len(records[1]) // 2
    data[at] ^= 255
    found = list(warc.salvage(bytes(data)))
    assert ids(found) == ["0", "2", "3", "4", "5"]
    gaps = [x for x in found if isinstance(x, warc.Gap)]
    assert [(g.offset, g.length) for g in gaps] == [(len(records[0]), len(records[1]))]
    covered(found, len(data))
    cut = bytes(data[: -len(records[5]) // 2])
    found = list(warc.salvage(cut))
    assert ids(found) == ["0", "2", "3", "4"] and isinstance(found[-1], warc.Gap)
    covered(found, len(cut))


def test_members():
    members = [gzip.compress(whole(i, bytes([i]) * 500), mtime=0) for i in range(5)]
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 8
    data = members[0] + b"junk" + members[1] + bytes(broken) + whole(9, b"plain") + members[3]
    data += members[4][:-3]
    found = list(warc.salvage(data))
    assert ids(found) == ["0", "1", "9", "3"]
    assert [x.length for x in found if isinstance(x, warc.Gap)] == [
        4, len(members[2]), len(members[4]) - 3
    ]
    covered(found, len(data))
    assert list(warc.salvage(b"")) == [] and len(list(warc.salvage(b"nothing here"))) == 1


def test_round_trip_of_odd_rows(spark):
    same = "<p>é</p>"
    rows = [
        (3, "u", same), (1, "u\r\nX: y", same), (2, None, None), (5, "u", ""), (1, "u", "\r\n\r\nWARC/1.1\r\n"),
        (None, "u", same), (4, "u", "x" * 300_000), (4, "u", "x" * 300_000),
    ]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, key int")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    out = warc.read_archives(spark, path).collect()
    assert len(out) == len(rows) and {r.kind for r in out} == {"record"}
    got = sorted(
        ((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in out),
        key=str,
    )

    def line(i, kind, to, html):
        data = (html or "").encode()
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        return (i, kind, to, len(data), sha)

    assert got == sorted([
        line("3", "revisit", "1", same), line("1", "response", None, same),
        line("2", "response", None, ""), line("5", "revisit", "2", ""),
        line("1", "response", None, rows[4][2]), line("none", "revisit", "1", same),
        line("4", "response", None, rows[6][2]), line("4", "response", None, rows[6][2]),
    ], key=str)
    assert {r.payload.decode() for r in out if r.record_type == "response"} == {same, "", rows[4][2], rows[6][2]}
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages.limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def test_query(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault(p.html or "", p.page_id)
    out = {r.page_id: r for r in QUERIES["op3_warc_salvage"](spark, data).collect()}
    assert len(out) == len(pages)
    for p in pages:
        row, payload = out[p.page_id], (p.html or "").encode()
        assert row.payload_bytes == len(payload) and row.payload_digest == warc.digest(payload)
        original = first[p.html or ""]
        assert row.refers_to == (None if original == p.page_id else original)
        assert row.record_type == ("response" if original == p.page_id else "revisit")


def test_many_small_members_take_time_in_proportion():
    def seconds(n):
        data = b"".join(
            gzip.compress(warc.record(str(i), "u", b"x" * 20, warc.digest(b"x" * 20), None) + b"\r\n", 1) for i in range(n)
        )
        begin = time.process_time()
        assert sum(isinstance(x, warc.Record) for x in warc.salvage(data)) == n
        return time.process_time() - begin

    seconds(100)
    # in proportion it is 4, with a copy of the rest per member 16
    assert seconds(40_000) < 8 * seconds(10_000)


def test_members_longer_than_a_window():
    draw = random.Random(3)
    payloads = [draw.randbytes(n) for n in (warc.WINDOW * 3, 10, warc.WINDOW - 200, warc.WINDOW * 5 + 1)]
    members = [gzip.compress(warc.record(str(i), "u", p, warc.digest(p), None) + b"\r\n") for i, p in enumerate(payloads)]
    cut = members[0][:-9]
    out = list(warc.salvage(b"".join([*members, cut, *members, cut])))
    assert [x.payload if isinstance(x, warc.Record) else None for x in out] == [*payloads, None, *payloads, None]
    assert [x.length for x in out] == [*map(len, members), len(cut)] * 2
