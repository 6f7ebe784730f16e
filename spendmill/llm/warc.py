"""WARC archives: write captures, read records back, and assemble transactions.

Archives are written by Spark's text writer, whose line separator is the two line ends that close every WARC
record, and read as binary files; both go through Spark, so they work on any store it reaches. A capture is a
response (or a revisit of an equal payload), its request and its metadata record, tied by
``WARC-Concurrent-To``; ``assemble`` joins them back into one nested row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import stored

RECORDS_PER_FILE = 12_000
#: A file is read as one value, which Spark bounds at 2 GB: payloads over ``LARGE_BYTES`` go to files of fewer records.
LARGE_BYTES, FILE_BYTES = 1 << 16, 1 << 28
UNPACK_BYTES = 1 << 20
# Names and forms of the WARC 1.1 format.
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADS = ("response", "revisit", "resource")

_RECORD = (
    "record_id string, warc_type string, concurrent_to array<string>, refers_to string, target_uri string, "
    "headers map<string,string>, fields map<string,string>, payload_bytes long, payload_digest string"
)
_SPACE = uuid.UUID("8f0c5a0e-6f3b-5d0f-9b61-2f2f6c1f8a11")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(*what: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, '|'.join(map(str, what)))}>"


def _clean(value: str) -> str:
    """Header values hold no control characters or spaces: they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record(kind: str, record_id: str, block: bytes, date: str, content_type: str, **more: str | None) -> bytes:
    """A record without the two line ends that close it."""
    names = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date}
    names |= {k.replace("_", "-"): v for k, v in more.items() if v is not None}
    names |= {"Content-Type": content_type, "Content-Length": str(len(block))}
    return b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in names.items())]) + b"\r\n\r\n" + block


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [(x or "").encode() for x in batch["html"].to_pylist()]
        digests, sizes = [payload_digest(x) for x in payloads], pa.array([len(x) for x in payloads], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string()), sizes], [*batch.schema.names, "digest", "size"])


def _render(date: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three records for each page."""
    for batch in batches:
        out: list[bytes] = []
        for page in batch.to_pylist():
            page_id, digest, uri, row = page["page_id"], page["digest"], page["url"], page["row"]
            first = page["first_row"] is None or page["first_row"] == row
            head = _record_id(page_id, digest, row)
            payload = (page["html"] or "").encode()
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            about = {"WARC_Target_URI": None if uri is None else _clean(uri), "WARC_Payload_Digest": f"sha1:{digest}"}
            answer = "application/http;msgtype=response"
            if first:
                out.append(_record("response", head, http.encode() + payload, date, answer, **about))
            else:
                target = {"WARC_Profile": REVISIT_PROFILE, "WARC_Refers_To": _record_id(page["original"], digest, page["first_row"])}
                out.append(_record("revisit", head, http.encode(), date, answer, **about, **target))
            tied = {"WARC_Target_URI": about["WARC_Target_URI"], "WARC_Concurrent_To": head}
            try:
                place = urlsplit(_clean(uri or ""))
                line = f"GET {place.path or '/'}{'?' * bool(place.query)}{place.query} HTTP/1.1\r\nHost: {place.netloc}\r\n\r\n"
            except ValueError:  # not a URL: it is kept as the target all the same
                line = "GET / HTTP/1.1\r\n\r\n"
            out.append(_record("request", _record_id(head, "request"), line.encode(), date, "application/http;msgtype=request", **tied))
            fields = "" if page_id is None else f"page-id: {page_id}\r\n"
            out.append(_record("metadata", _record_id(head, "metadata"), fields.encode(), date, "application/warc-fields", **tied))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    smallest: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    records_per_file: int = RECORDS_PER_FILE,
    compression: str = "gzip",
) -> None:
    """Write a capture for each row of ``pages`` (page_id, url, html; other columns are not read).

    Of rows with equal payloads of at least ``smallest`` bytes the one with the smallest page_id (nulls last) is
    a response, the others revisit it. Null html is an empty payload, a null url gives no target, a null page_id
    no page-id field. Repeated rows are captures of their own.

    The rows are numbered once. Originals are found by digest among rows without their payloads and come to the pages
    by row number, so pages of one id, null among them, spread over the tasks. No file holds more than
    ``records_per_file`` records of at most 64 KB payload, or, of larger ones, about 256 MB (and one capture at least).
    An empty table writes no record.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.monotonically_increasing_id().alias("row"))
    hashed = stored(rows.mapInArrow(_digests, "page_id long, url string, html string, row long, digest string, size long"), "pages")
    narrow = hashed.where(F.col("size") >= smallest).select("row", "page_id", "digest")
    least = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")).alias("least")
    groups = narrow.groupBy("digest").agg(least, F.count("*").alias("n"))
    several = groups.where("n > 1").select("digest", F.col("least.page_id").alias("original"), F.col("least.row").alias("first_row"))
    known = narrow.select("row", "digest").join(several, "digest").select("row", "original", "first_row")
    tied = hashed.join(known, "row", "left")
    largest = hashed.agg(F.max("size").alias("size")).first()["size"] or 0
    small = F.col("size") <= LARGE_BYTES
    parts = [(tied, records_per_file)]
    if largest > LARGE_BYTES:
        parts = [(tied.where(small), records_per_file), (tied.where(~small), min(records_per_file, 3 * max(1, FILE_BYTES // largest)))]
    for rows, most in parts:
        records = rows.mapInArrow(partial(_render, date), "record binary")
        writer = records.select(F.col("record").cast("string").alias("value")).write.mode("append")
        writer.option("lineSep", END).option("maxRecordsPerFile", most).option("compression", compression).text(path)


def unpacked(content: bytes, step: int = UNPACK_BYTES) -> Iterator[bytes]:
    """The bytes of an archive in parts of about ``step``: plain, or gzip of any number of members, one after the other."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(view):
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(view):
                raise ValueError("the last gzip member is cut off")
            data = view[at : at + step]
            at += len(data)
            while len(data) and not member.eof:
                if part := member.decompress(data, step):
                    yield part
                data = member.unconsumed_tail
        at -= len(member.unused_data)
        while at < len(view) and view[at] == 0:  # padding between members
            at += 1


class _Parts:
    """Bytes that come in parts, taken up to a mark or by length; only what is not yet taken is held."""

    def __init__(self, parts: Iterable[bytes]) -> None:
        self.parts, self.held, self.at, self.before = iter(parts), b"", 0, 0

    def _more(self) -> bool:
        part = next(self.parts, None)
        if part is None:
            return False
        self.before += self.at
        self.held, self.at = self.held[self.at :] + part, 0
        return True

    def place(self) -> int:
        return self.before + self.at

    def ended(self) -> bool:
        while self.at >= len(self.held):
            if not self._more():
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.held.find(mark, self.at)) < 0:
            if not self._more():
                return None
        taken, self.at = self.held[self.at : end], end + len(mark)
        return taken

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, or fewer at the end."""
        if len(self.held) - self.at < n:
            found = [self.held[self.at :]]
            size = len(found[0])
            while size < n and (part := next(self.parts, None)) is not None:
                found.append(part)
                size += len(part)
            self.before += self.at
            self.held, self.at = b"".join(found), 0
        taken = self.held[self.at : self.at + n]
        self.at += len(taken)
        return taken


def parse_records(data: bytes | Iterable[bytes]) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(headers, block) of each record of an archive, given whole or in parts; damage raises ValueError."""
    parts = _Parts([data] if isinstance(data, bytes) else data)
    while not parts.ended():
        at = parts.place()
        head = parts.until(b"\r\n\r\n")
        lines = (head or b"").decode(errors="replace").split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        headers: dict[str, list[str]] = {}
        for name, _, value in (x.partition(":") for x in lines[1:]):
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        block = parts.take(size)
        if len(block) < size or parts.take(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, block


def _parse(with_payload: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]
    kinds += [pa.map_(pa.string(), pa.string())] * 2 + [pa.int64(), pa.string()] + [pa.binary()] * with_payload
    names = [x.strip().split(" ")[0] for x in re.sub(r"<[^>]*>", "", _RECORD).split(",")] + ["payload"] * with_payload

    def rows(content: bytes) -> Iterator[tuple]:
        for headers, block in parse_records(unpacked(content)):
            one = {k: v[0] for k, v in headers.items()}
            kind, payload, fields = one["warc-type"], None, {}
            if kind == "metadata":
                fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode(errors="replace").split("\r\n")) if k}
            elif kind == "response":
                payload = block.partition(b"\r\n\r\n")[2] if one.get("content-type", "").startswith("application/http") else block
            elif kind == "resource":
                payload = block
            digest = one.get("warc-payload-digest", "").removeprefix("sha1:") or None if payload is None else payload_digest(payload)
            size = None if payload is None else len(payload)
            row = (one["warc-record-id"], kind, headers.get("warc-concurrent-to", []), one.get("warc-refers-to"))
            row += (one.get("warc-target-uri"), list(one.items()), list(fields.items()), size, digest)
            yield row + (payload,) * with_payload

    for batch in batches:
        for content in batch["content"]:
            held: list[tuple] = []
            for row in rows(content.as_py()):
                held.append(row)
                if len(held) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def read_records(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """One row per record of all archives under ``path``; without ``payload`` its length and digest only.

    Files may be plain or gzip with any number of members, as with a member for each record. A task unpacks a file as it
    goes, about a megabyte and one record at a time. Damage is an error; no record gives no row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(partial(_parse, payload), _RECORD + ", payload binary" * payload)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its head record (response, revisit or resource), requests and metadata records.

    A record belongs to the head that its ``concurrent_to`` names, that names it, or that the record it names
    belongs to. Records tied to no head are left out; a head without request or metadata has empty arrays. Joins
    go by the ids' MD5, which is a third of their length.
    """
    is_head = F.col("warc_type").isin(*HEADS)
    names = [c for c in records.columns if c != "concurrent_to"]
    heads = records.where(is_head).select(_key("record_id").alias("capture"), "concurrent_to", F.struct(*names).alias("head"))
    tails = records.where(~is_head).select(_key("record_id").alias("id"), F.explode_outer("concurrent_to").alias("to"), F.struct(*names).alias("part"))
    tails = tails.withColumn("capture", _key("to")).drop("to")
    known = heads.select("capture")
    direct = tails.join(known, "capture", "left_semi")
    loose = tails.join(known, "capture", "left_anti")
    via = direct.select(F.col("id").alias("capture"), F.col("capture").alias("owner"))
    named = heads.select(F.explode("concurrent_to").alias("to"), F.col("capture").alias("owner")).select(_key("to").alias("id"), "owner")
    further = loose.join(via, "capture").select("id", "owner", "part").union(loose.join(named, "id").select("id", "owner", "part"))
    further = further.dropDuplicates(["id", "owner"]).select("id", F.col("owner").alias("capture"), "part")
    tied = direct.select("id", "capture", "part").union(further)

    def by_id(kind: str) -> Column:
        """A capture's records of one kind, ordered by record id (maps themselves cannot be compared)."""
        own = F.collect_list(F.when(F.col("part.warc_type") == kind, F.col("part")))
        return F.array_sort(own, lambda x, y: F.when(x["record_id"] < y["record_id"], -1).when(x["record_id"] > y["record_id"], 1).otherwise(0))

    parts = tied.groupBy("capture").agg(by_id("request").alias("requests"), by_id("metadata").alias("metadata"))
    return heads.join(parts, "capture", "left").select(
        F.col("head.record_id").alias("capture_id"),
        "head",
        F.coalesce("requests", F.array()).alias("requests"),
        F.coalesce("metadata", F.array()).alias("metadata"),
    )


def _key(record_id: str) -> Column:
    return F.unhex(F.md5(record_id))


def captures(records: DataFrame) -> DataFrame:
    """Assembled captures as page_id, payload_bytes, payload_digest, record_type, refers_to (the response's page_id)."""
    page_id = F.col("fields")["page-id"].cast("long").alias("page_id")
    narrow = records.select("record_id", "warc_type", "concurrent_to", "refers_to", page_id, "payload_bytes", "payload_digest")
    rows = stored(
        assemble(narrow).select(
            _key("capture_id").alias("capture"),
            F.col("metadata")[0]["page_id"].alias("page_id"),
            "head.payload_bytes",
            "head.payload_digest",
            F.col("head.warc_type").alias("record_type"),
            _key("head.refers_to").alias("refers"),
        ),
        "captures",
    )
    answers = rows.where("record_type = 'response'").select(
        F.col("capture").alias("refers"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes")
    )
    # Only revisits look up a response.
    revisits = rows.where("refers is not null").join(answers, "refers", "left")
    others = rows.where("refers is null").withColumns({"refers_to": F.lit(None).cast("long"), "full_bytes": F.lit(None).cast("long")})
    return revisits.unionByName(others).select(
        "page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
