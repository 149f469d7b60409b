"""WARC archives: a writer on Spark's own text sink, and a salvage reader.

Writer: a record is a row, its terminator CR LF CR LF is the sink's line separator, so that archives
go through Spark's commit protocol to any store Spark can write, and a lost executor's files are
written again. Payloads that occur more than once are written once: the response; the others are
revisit records that hold HTTP headers only.

Reader: each file is parsed record by record (plain, or gzip members). A record is valid if its version
line, headers, length, terminator and digests hold. After a failed check the reader searches for the
next gzip member or version line that begins a valid record, goes on there, and logs the bytes between
as a quarantined gap. Inside a gzip member, broken ones up to the break, records are salvaged the same way.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Generator, Iterator
from functools import reduce
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.llm.shared import bloom, cut, flagged, join_spread

END = "\r\n\r\n"
#: Payload bytes of an archive file, as a reader's task takes a file as a whole: on average, and at most whatever the order (or one record).
FILE_BYTES, FILE_BYTES_MOST = 32 << 20, 128 << 20
#: Payload bytes up to which a payload is of the first class, the second, and so on.
CLASSES = (64 << 10, 2 << 20)
#: Bytes of a member's content that are kept from the first inflation (more is inflated again), bytes of a member inflated at once, and bytes of a
#: record from which its terminator is looked up before it is read.
KEPT, STEP, LARGE = 8 << 20, 1 << 14, 32 << 20
_HEX32, _RFC32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(c: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string or binary column: ten hex digits are eight base-32 digits."""
    h = F.sha1(c)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _HEX32, _RFC32)


def _line(c: Column) -> Column:
    """A header value: control characters and blanks as percent codes, so that no value ends its line."""
    out = F.coalesce(c, F.lit(""))
    for ch in "\r\n\t ":
        out = F.replace(out, F.lit(ch), F.lit(f"%{ord(ch):02X}"))
    return F.regexp_replace(out, r"[\x00-\x1F\x7F]", "%00")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(record string): one WARC/1.1 record per row, without its terminator.

    Of rows with equal payloads (the null payload is empty) those of the smallest id are responses and
    the others revisits of it; a null id is larger than any other. Other columns are ignored.
    A payload is shuffled only if a filter of bounded size says that its digest may occur again.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), _line(F.col(url_col).cast("string")).alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload")
    ).withColumn("digest", base32_sha1(F.col("payload")))
    groups = cut(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1"), "payloads")
    if groups.isEmpty():
        both = rows.withColumn("first", F.col("id"))
    else:
        again = bloom(groups.select(F.xxhash64("digest").alias("h")), "h")
        marked = flagged(rows, F.xxhash64("digest"), again, "maybe")
        alone = marked.where("not maybe").withColumn("first", F.col("id"))
        known = join_spread(marked.where("maybe"), groups, ["digest"], "n", "left").drop("n").withColumn("first", F.coalesce("first", "id"))
        both = alone.unionByName(known)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    revisit = ~F.col("id").eqNullSafe(F.col("first"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("id")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.col("url"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), urn(F.col("first")))).otherwise(F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(block)).cast("string"), F.lit(END),
    )
    return both.select(F.concat(head, http, block).alias("record"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", **more) -> None:
    """Write the records of pages as archives below path, in files of FILE_BYTES or so, FILE_BYTES_MOST at most.

    Payloads are written by classes of their sizes, as a class's files have as many records as its largest allows: one huge payload
    leaves the files of small ones as they are. Equal payloads are of one class.
    """
    size = F.coalesce(F.octet_length(F.col(payload_col).cast("string")), F.lit(0))
    cls = reduce(lambda c, k: c.when(size <= CLASSES[k], k), range(1, len(CLASSES)), F.when(size <= CLASSES[0], 0)).otherwise(len(CLASSES))
    known = pages.groupBy(cls.alias("cls")).agg(F.max(size), F.avg(size)).collect()  # a row a class
    for k, most, mean in known or [(0, 0, 0)]:
        n = max(1, min(FILE_BYTES // (int(mean) + 1024), FILE_BYTES_MOST // (most + 1024)))
        records(pages.where(cls == k), id_col, url_col, payload_col, **more).write.mode("append").option("lineSep", END).option("maxRecordsPerFile", n).text(path)


class Bad(Exception):
    """Why the bytes at a place are no valid record."""


_NEXT = re.compile(rb"WARC/1\.[01]\r?\n|\x1f\x8b\x08")
_VERSION = re.compile(rb"WARC/1\.[01]\r?\n")


def _sha1(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class More(Exception):
    """A window that ends before the record does: bytes that are needed from the record's begin on."""

    def __init__(self, need: int):
        self.need = need


def parse(data: bytes, at: int, left: int | None = None) -> tuple[dict, int]:
    """The record at a place (its headers, its payload under "payload") and the place after its terminator.

    left: bytes that there are from the place on, if data is a window that may end before them.
    """
    held = len(data) - at
    left = held if left is None else left
    m = _VERSION.match(data, at)
    if not m:
        raise Bad("no version line")
    stop = data.find(b"\r\n\r\n", m.end() - 2)
    if stop < 0:
        if held < left:
            raise More(2 * held)
        raise Bad("headers without end")
    head: dict = {}
    for line in data[m.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("a header line without a colon")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = head.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise Bad("no content length")
    start, end = stop + 4, stop + 4 + int(size)
    if end - at > left:
        raise Bad("cut off")
    if end + 4 - at > left:
        raise Bad("no terminator")
    if end + 4 > len(data):
        raise More(end + 4 - at)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Bad("no terminator")
    block = data[start:end]
    if (want := head.get("warc-block-digest", "")).startswith("sha1:") and _sha1(block) != want[5:].upper():
        raise Bad("block digest differs")
    payload, told = block, None
    if head.get("content-type", "").startswith("application/http"):
        http, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise Bad("HTTP headers without end")
        if m := re.search(rb"(?mi)^content-length:\s*(\d+)", http):
            told = int(m[1])
    if head.get("warc-type") == "revisit":
        head["payload"], head["payload_bytes"] = None, told
        head["digest"] = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    else:
        digest = _sha1(payload)
        if (want := head.get("warc-payload-digest", "")).startswith("sha1:") and digest != want[5:].upper():
            raise Bad("payload digest differs")
        if told is not None and told != len(payload):
            raise Bad("HTTP length differs")
        head |= {"payload": payload, "payload_bytes": len(payload), "digest": digest}
    return head, end + 4


def inflate(data: bytes, at: int) -> Generator[bytes, None, tuple[int | None, str | None]]:
    """The content of the gzip member at a place in pieces; returns the place after it, or None and why it is broken after its last piece."""
    d, view, n = zlib.decompressobj(31), memoryview(data), at
    while not d.eof and n < len(data):
        before = d.copy()
        try:
            piece = d.decompress(view[n : n + STEP])
        except zlib.error as e:
            for k in range(n, n + STEP):  # up to the byte that fails
                try:
                    piece = before.decompress(view[k : k + 1])
                except zlib.error:
                    break
                yield piece
            return None, f"gzip: {e}"
        yield piece
        n += STEP
    if not d.eof:
        return None, "gzip member cut off"
    return min(n, len(data)) - len(d.unused_data), None


class Member:
    """A gzip member: its content's size, the place after it (None: broken), and windows of its content."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at, self.size = data, at, 0
        kept: list[bytes] | None = []
        pieces = inflate(data, at)
        while True:
            try:
                piece = next(pieces)
            except StopIteration as e:
                self.end, self.broken = e.value
                break
            self.size += len(piece)
            if kept is not None:
                kept.append(piece)
                if self.size > KEPT:
                    kept = None
        self.whole = kept is not None
        self.buffer, self.base = bytearray(b"".join(kept or [])), 0
        self.pieces = iter(()) if self.whole else inflate(data, at)

    def window(self, low: int, high: int) -> bytes:
        """Content from low to high, which must not begin before what was released."""
        while self.base + len(self.buffer) < min(high, self.size):
            self.buffer += next(self.pieces)
        return bytes(self.buffer[low - self.base : high - self.base])

    def release(self, low: int) -> None:
        """What is before `low` isn't asked for again."""
        if not self.whole and low - self.base > KEPT // 8:
            del self.buffer[: low - self.base]
            self.base = low

    def _ends(self, at: int) -> bool:
        """Whether a terminator stands at a place, without holding what is before it."""
        seen, tail = 0, b""
        for piece in inflate(self.data, self.at):
            if seen + len(piece) > at:
                tail += piece[max(0, at - seen) :]
                if len(tail) >= 4:
                    break
            seen += len(piece)
        return tail[:4] == b"\r\n\r\n"

    def record(self, at: int) -> tuple[dict, int]:
        """parse() at a place of the content."""
        take = 1 << 16
        while True:
            try:
                rec, end = parse(self.window(at, at + take), 0, self.size - at)
                return rec, at + end
            except More as m:
                if m.need > LARGE and not self.whole and m.need > 2 * take and not self._ends(at + m.need - 4):
                    raise Bad("no terminator") from None
                take = max(m.need, 2 * take)

    def next(self, at: int) -> int:
        """The next place after `at` where a valid record begins, or the end of the content."""
        low = at + 1
        while low < self.size:
            self.release(low)
            window = self.window(low, low + (1 << 16))
            m = _VERSION.search(window)
            if not m:
                low += max(1, len(window) - 16)  # a version line may lie across the edge
                continue
            low += m.start()
            try:
                self.record(low)
                return low
            except Bad:
                low += 1
        return self.size

    def parts(self) -> Iterator[tuple[dict | None, str | None]]:
        """(record, None) of every valid record of the content, and (None, reason) of every gap, in order."""
        at = 0
        while at < self.size:
            self.release(at)
            try:
                rec, at = self.record(at)
                yield rec, None
            except Bad as e:
                end = self.next(at)
                yield None, f"{e}: bytes {at} to {end} of the member's content"
                at = end


def _valid(data: bytes, at: int) -> tuple[Iterator[tuple[dict | None, str | None]], int | None]:
    """What the record or gzip member at a place holds, and the place after it; None if a member is broken. Bad if there is no valid record.

    A broken member of one record is set aside as a whole.
    """
    if data[at : at + 2] != b"\x1f\x8b":
        rec, end = parse(data, at)
        return iter([(rec, None)]), end
    m = Member(data, at)
    parts = m.parts()
    head = list(islice(parts, 2))  # gaps don't follow one another: of two parts one is a record
    valid = any(rec is not None for rec, _ in head)
    if m.broken and (not valid or len(head) == 1):
        raise Bad(m.broken)
    if head and not valid:
        raise Bad(head[0][1].rpartition(": bytes ")[0])
    return chain(head, parts, [(None, m.broken)] * bool(m.broken)), m.end


def _next(data: bytes, at: int) -> int:
    """The next place after `at` that begins something valid, or the end."""
    for m in _NEXT.finditer(data, at + 1):
        try:
            _valid(data, m.start())
            return m.start()
        except Bad:
            continue
    return len(data)


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """(start, end, record, None) of every valid record, and (start, end, None, reason) of every gap, in order.

    Records and gaps inside a gzip member have the member's place; a broken member ends where something valid begins. A member's records are
    yielded as its content goes by.
    """
    at = 0
    while at < len(data):
        try:
            found, end = _valid(data, at)
        except Bad as e:
            found, end = iter([(None, str(e))]), None
        if end is None:
            end = _next(data, at)
        for rec, why in found:
            yield at, end, rec, why
        at = end


_OUT = "archive string, start long, end long, gap string, record_id string, type string, target_uri string, refers_to string, payload_digest string, payload_bytes long"


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Every record and every quarantined gap of the archives below path, one row each.

    gap is null for a record, else the reason why the bytes from start to end were set aside; they
    hold no valid record but those of the same gzip member. payload=True adds the payload (null for revisits and gaps). An empty file
    gives no row. An archive's own bytes are read as a whole (Spark fails on files of 2 GB and more); what its gzip members hold streams by, of any size.
    """

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows: list[tuple] = []
                held = 0
                for start, end, r, why in salvage(data.as_py() or b""):
                    get = r.get if r else (lambda *_: None)
                    row = (name, start, end, why, get("warc-record-id"), get("warc-type"), get("warc-target-uri"), get("warc-refers-to"), get("digest"), get("payload_bytes"))
                    rows.append((*row, get("payload")) if payload else row)
                    held += (get("payload_bytes") or 0) if payload else 64
                    if held > 8 << 20:
                        yield _batch(rows, payload)
                        rows, held = [], 0
                yield _batch(rows, payload)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, _OUT + ", payload binary" * payload)


def _batch(rows: list[tuple], payload: bool) -> pa.RecordBatch:
    names = [x.split()[0] for x in _OUT.split(", ")] + ["payload"] * payload
    kinds = [pa.int64() if x.endswith(" long") else pa.string() for x in _OUT.split(", ")] + [pa.binary()] * payload
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
