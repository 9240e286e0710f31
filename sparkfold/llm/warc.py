"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Archives are written through Spark's text sink, so that any file system Spark knows will do; a
record is a row. The reader checks every record (header, length, record end, payload digest) or
gzip member (checksum). After a failed check it looks for the next member or version line that
passes, goes on from there, and logs the bytes in between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.llm.common import join_few, kept_table

#: Fixed values of the format.
VERSION, RECORD_END, MEMBER = b"WARC/1.1\r\n", b"\r\n\r\n", b"\x1f\x8b\x08"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
#: Records per archive file.
VOLUME = 1000
#: Bytes of an archive that are inflated at a time.
WINDOW = 1 << 14
#: Text of an id that is NULL.
NO_ID = "none"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    record_id: str, uri: str | None, payload: bytes, payload_digest: str, refers_to: str | None
) -> bytes:
    """One record without its last two bytes, which the sink writes as the row's end."""
    block = HTTP + (payload if refers_to is None else b"")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{record_id}>",
        "WARC-Target-URI": None if uri is None else re.sub(r"[\x00-\x20\x7f]", "%20", uri),
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "WARC-Payload-Length": str(len(payload)),
        "WARC-Refers-To": None if refers_to is None else f"<urn:page:{refers_to}>",
        "WARC-Profile": None
        if refers_to is None
        else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n"


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to: the page whose equal payload stands for this one.

    Only ids and digests are shuffled. Of equal payloads of at least ``min_bytes`` bytes the row
    with the smallest page_id is the original; rows that repeat this id are originals as well, a
    NULL id never is unless no other id has the payload.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html")
    keyed = rows.select("page_id", F.sha2(payload, 256).alias("key")).where(
        F.octet_length(payload) >= min_bytes
    )
    first = keyed.groupBy("key").agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
    # the few keys with copies are spread over salts, for one of them may hold a third of the rows
    salts = 32
    copied = first.where("n > 1").select(
        "key", "original", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    )
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    again = (
        salted.join(copied, ["key", "salt"])
        .where("NOT (page_id <=> original)")
        .select(F.col("page_id").alias("id"), F.col("key").alias("k"), "original")
        .distinct()
    )
    left = rows.withColumn("key", F.sha2(payload, 256))
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k"))
    joined = join_few(left, kept_table(again, "revisits"), same, "left")
    return joined.select("page_id", "url", "html", F.col("original").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, *, min_bytes: int = 0) -> None:
    """Write one record per row of pages (page_id, url, html) as .warc files of up to 1000 records.

    A NULL html is an empty payload, a NULL url leaves its field out, control characters in a url
    are escaped. Other columns are ignored; an empty table gives no record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256).to_pylist()
                done = []
                for row in rows:
                    payload = (row["html"] or "").encode()
                    done.append(
                        record(row["id"], row["url"], payload, digest(payload), row["refers_to"])
                    )
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["record"])

    rows = with_originals(pages, min_bytes).select(
        F.coalesce(F.col("page_id").cast("string"), F.lit(NO_ID)).alias("id"),
        "url",
        "html",
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    (
        rows.mapInArrow(run, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n").option("maxRecordsPerFile", VOLUME)
        .text(path)
    )


class Record(NamedTuple):
    offset: int
    length: int
    fields: dict[str, str]
    payload: bytes


class Gap(NamedTuple):
    offset: int
    length: int
    reason: str


def _record_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields, payload and end of the record that begins here; ValueError if a check fails."""
    version = _VERSION.match(data, at)
    if not version:
        raise ValueError("no version line")
    end = data.find(b"\r\n\r\n", version.end())
    if end < 0:
        raise ValueError("header does not end")
    fields = {}
    for line in data[version.end() : end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("broken header line")
        fields[name.strip().lower()] = value.strip()
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        raise ValueError("header lacks a field")
    start = end + 4
    stop = start + int(fields["content-length"])
    if data[stop : stop + 4] != RECORD_END:
        raise ValueError("block does not end where its length says")
    block = data[start:stop]
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    said = fields.get("warc-payload-digest", "")
    if fields["warc-type"] != "revisit" and said.startswith("sha1:") and digest(payload) != said[5:]:
        raise ValueError("payload does not match its digest")
    return fields, payload, stop + 4


def _member_at(data: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member that begins here; ValueError if it is damaged."""
    inflate, parts = zlib.decompressobj(31), []
    rest = memoryview(data)
    try:
        # by windows: what is not used of the last one is copied, so it must not be the whole rest
        while at < len(data) and not inflate.eof:
            parts.append(inflate.decompress(rest[at : at + WINDOW]))
            at = min(at + WINDOW, len(data))
    except zlib.error as error:
        raise ValueError(f"damaged member: {error}") from None
    if not inflate.eof:
        raise ValueError("truncated member")
    return b"".join(parts), at - len(inflate.unused_data)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records and gaps of an archive in order; together they cover all of its bytes.

    A member's records carry the member's offset and length; what is damaged inside a sound
    member is a gap at the member's place. Trailing line ends after a record belong to it.
    """
    at, bad, reason = 0, None, ""
    while at < len(data):
        inner: list[Record | Gap] = []
        try:
            if data.startswith(MEMBER, at):
                content, end = _member_at(data, at)
                inner = list(salvage(content))
            else:
                fields, payload, end = _record_at(data, at)
                inner = [Record(at, end - at, fields, payload)]
        except ValueError as error:
            if bad is None:
                bad, reason = at, str(error)
            found = _START.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if bad is not None:
            yield Gap(bad, at - bad, reason)
            bad = None
        yield from (x._replace(offset=at, length=end - at) for x in inner)
        at = end
    if bad is not None:
        yield Gap(bad, len(data) - bad, reason)


SCHEMA = (
    "path string, offset long, length long, kind string, reason string, record_type string, "
    "record_id string, target_uri string, refers_to string, payload binary, "
    "payload_bytes long, payload_digest string"
)


def read_archives(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """All records (kind 'record') and quarantined gaps (kind 'gap') of the files below a path.

    Both plain and gzip files are read, a file is one row of the binary source, hence at most 2 GB.
    A revisit's payload_bytes and payload_digest are those of the payload it stands for. With
    ``payloads=False`` the payload is checked but not returned. An empty folder or file has no row.
    """

    def named(value: str | None) -> str | None:
        return value[10:-1] if value and value.startswith("<urn:page:") else value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                done = []
                for x in salvage(batch.column(1)[i].as_buffer().to_pybytes()):
                    row = {"path": name, "offset": x.offset, "length": x.length, "kind": "gap"}
                    if isinstance(x, Gap):
                        done.append(row | {"reason": x.reason})
                        continue
                    f = x.fields
                    again = f["warc-type"] == "revisit"
                    done.append(
                        row
                        | {
                            "kind": "record",
                            "record_type": f["warc-type"],
                            "record_id": named(f.get("warc-record-id")),
                            "target_uri": f.get("warc-target-uri"),
                            "refers_to": named(f.get("warc-refers-to")),
                            "payload": x.payload if payloads else None,
                            "payload_bytes": int(f.get("warc-payload-length", 0))
                            if again
                            else len(x.payload),
                            "payload_digest": f.get("warc-payload-digest", "")[5:]
                            if again
                            else digest(x.payload),
                        }
                    )
                yield pa.RecordBatch.from_pylist(done, schema)

    schema = pa.schema(
        [
            (n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t])
            for n, t in (x.split() for x in SCHEMA.split(", "))
        ]
    )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").where("length > 0").mapInArrow(run, SCHEMA)
