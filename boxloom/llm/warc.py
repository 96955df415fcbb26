"""WARC archives: a writer with revisit records and a salvage reader.

Writing: one gzip member per record, into files of bounded size in a folder that all executors see.
A task writes files under fresh names and reports them as manifest rows; only files in the written
manifest are read, so what a lost or repeated task left behind counts for nothing.

Reading: each file is walked member by member (or version line by version line, if not compressed).
A member must inflate to its CRC, a record's length must end at its terminator and its payload must
have the stated digest. After a failed check the reader searches byte by byte for the next member or
version line that does begin a valid record, goes on there, and logs the bytes between as a gap. The
same search goes over the inflated bytes of a member, also over those that came out of a damaged one
before it broke: records in it that pass their checks are returned (of a damaged member only those with
a digest over their payload), and the stretches between are gaps that say where in the member they lie.
Rows of one member share its offset and length; a record from a damaged member has length 0, as
the gap after it covers the member's bytes.

Defined results: a null payload is an empty one; a null url gives a record without target; of
payloads below `least` bytes none is a revisit. A null id is never referred to, and copies none of
which has an id are all responses. Rows that repeat both the payload and its largest id are all
responses. Empty tables give no files and no rows. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Generator, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, ship

CHUNK = 1 << 20
#: Inflated bytes of a member that are held in memory; more are inflated a second time as they are read.
HOLD = 16 << 20
VERSION = b"WARC/1."
MAGIC = b"\x1f\x8b\x08"
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = (
    "file string, offset bigint, length bigint, record_type string, page_id bigint, url string, "
    "refers_to bigint, payload_bytes bigint, payload_digest string, payload binary, gap string"
)
MANIFEST_SCHEMA = "file string, records bigint, bytes bigint"


def open_store(uri: str):
    """(filesystem, path) of a URI that Python itself can open: local, or any store pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# Writing


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, not compressed. A revisit carries the HTTP header only, with the full length in it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def with_referrals(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, url, html, digest, refers_to). Copies are counted before the shuffle; the join's hot digests are split by AQE."""
    own = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long = F.octet_length("html") >= least
    first = own.where(long).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    return own.join(first, "digest", "left").select("page_id", "url", "html", "digest", refers)


def write_archives(pages: DataFrame, folder: str, least: int = 1000, roll: int = 64 << 20, level: int = 4) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives of about `roll` bytes; returns the committed manifest."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        out, done, name, count = None, [], "", 0
        for batch in batches:
            for page_id, url, html, digest, refers in batch.itertuples(index=False, name=None):
                if out is None:
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                refers = None if pd.isna(refers) else int(refers)
                out.write(member(record(None if pd.isna(page_id) else int(page_id), url, html.encode(), digest, refers), level))
                count += 1
                if out.tell() >= roll:
                    done.append((f"{folder}/{name}", count, out.tell()))
                    out.close()
                    out = None
        if out is not None:
            done.append((f"{folder}/{name}", count, out.tell()))
            out.close()
        yield pd.DataFrame(done, columns=["file", "records", "bytes"])

    spark = pages.sparkSession
    ship(spark)
    ready = with_referrals(pages, least).withColumn("page_id", F.col("page_id").cast("decimal(20,0)")).withColumn(
        "refers_to", F.col("refers_to").cast("decimal(20,0)")
    )
    manifest = scratch(spark, "warc-manifest")
    ready.mapInPandas(write, MANIFEST_SCHEMA).write.parquet(manifest)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)


# Reading


class Window:
    """Random access to a file with one chunk kept, so that a search touches each byte once."""

    def __init__(self, source, size: int):
        self.source, self.size, self.at, self.held = source, size, 0, b""

    def read(self, start: int, count: int) -> bytes:
        count = max(0, min(count, self.size - start))
        if not (self.at <= start and start + count <= self.at + len(self.held)):
            self.source.seek(start)
            self.at, self.held = start, self.source.read(min(max(count, CHUNK), self.size - start))
        return self.held[start - self.at : start - self.at + count]


class Inflated:
    """The first `size` inflated bytes of the member at `start`, read forwards: what lies before the last read is let go."""

    def __init__(self, view: Window, start: int, size: int):
        self.source, self.size, self.at, self.held = inflating(view, start), size, 0, bytearray()

    def read(self, start: int, count: int) -> bytes:
        count = max(0, min(count, self.size - start))
        while self.at + len(self.held) < start + count:
            if start > self.at:
                gone = min(start - self.at, len(self.held))
                del self.held[:gone]
                self.at += gone
            self.held += next(self.source)
        return bytes(self.held[start - self.at : start - self.at + count])


class Held:
    """Bytes in memory, read as the other two are."""

    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def read(self, start: int, count: int) -> bytes:
        return self.data[start : start + count]


def header_end(data: bytes, start: int, ended: bool = True) -> int:
    """Where the blank line after the header at `start` stands, however long that is; -1 if more data must tell."""
    at = start
    while True:
        stop = data.find(b"\r\n", at)
        if stop < 0:
            if ended:
                raise ValueError("header not ended")
            return -1
        if stop == at:
            return at - 2
        if at > start and data[at] not in b" \t" and data.find(b":", at, stop) < 0:
            raise ValueError("header not ended")
        at = stop + 2


def parse(source: Window | Inflated | Held, start: int) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the record at `start`; ValueError says which check failed."""
    if source.read(start, len(VERSION)) != VERSION:
        raise ValueError("no version line")
    much = 1 << 16
    while (stop := header_end(data := source.read(start, much), 0, start + much >= source.size)) < 0:
        much *= 2
    lines = data[:stop].split(b"\r\n")[1:]
    head = {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines)}
    if not head.get("content-length", "").isdigit():
        raise ValueError("no length")
    first = stop + 4
    last = first + int(head["content-length"])
    whole = source.read(start, last + 4) if start + last + 4 <= source.size else b""  # from its start, as the search may go back there
    if whole[last:] != b"\r\n\r\n":
        raise ValueError("length does not meet the terminator")
    return head, whole[first:last], start + last + 4


def describe(head: dict, block: bytes) -> dict:
    """A record's columns, with its payload checked against the stated digest."""
    ident = lambda k: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", head.get(k, ""))) else None
    http, _, payload = block.partition(b"\r\n\r\n")
    if "application/http" not in head.get("content-type", ""):
        http, payload = b"", block
    kind, stated = head.get("warc-type", ""), head.get("warc-payload-digest", "")
    if stated.startswith("sha1:"):
        stated = base64.b32decode(stated[5:]).hex()
    if kind == "revisit":
        full = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        size, found = int(full[1]) if full else None, stated or None
    else:
        size, found = len(payload), hashlib.sha1(payload).hexdigest()
        if stated and stated != found:
            raise ValueError("payload digest differs")
    return {
        "record_type": kind, "page_id": ident("warc-record-id"), "url": head.get("warc-target-uri"), "refers_to": ident("warc-refers-to"),
        "payload_bytes": size, "payload_digest": found, "payload": payload, "gap": None,
    }


def inflating(view: Window, start: int) -> Generator[bytes, None, tuple[int, str]]:
    """The bytes that the gzip member at `start` inflates to, up to its end or to what is damaged; returns (end, damage)."""
    engine, at = zlib.decompressobj(31), start
    while not engine.eof:
        raw = view.read(at, 1 << 16)
        if not raw:
            return at, "member cut off"
        before, at = engine.copy(), at + len(raw)
        try:
            yield engine.decompress(raw)
        except zlib.error as broken:
            yield until_broken(before, raw)
            return at, f"member damaged: {broken}"
    return at - len(engine.unused_data), ""


def inflate(view: Window, start: int) -> tuple[Held | Inflated, int, str]:
    """(inflated bytes, end, damage) of the gzip member at `start`; zlib checks its CRC and length.

    They are held if they are `HOLD` at most; else they are inflated a second time as they are read.
    """
    parts, size, source = [], 0, inflating(view, start)
    while True:
        try:
            part = next(source)
        except StopIteration as done:
            end, damage = done.value
            return (Held(b"".join(parts)) if size <= HOLD else Inflated(view, start, size)), end, damage
        size += len(part)
        parts.append(part)
        if size > HOLD:
            parts.clear()


def until_broken(engine, raw: bytes) -> bytes:
    """What `raw` inflates to up to the byte that fails."""
    out = []
    try:
        for i in range(len(raw)):
            out.append(engine.decompress(raw[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(out)


def within(source: Held | Inflated, damage: str) -> Iterator[dict]:
    """The valid records in the inflated bytes of a member, and the gaps between; of a damaged member only proven records.

    A record is proven if its payload has the stated digest. Of a damaged member gaps are not told
    apart: the whole member becomes one.
    """
    at = 0
    while at < source.size:
        start, reason, row = at, "", None
        while at < source.size:
            try:
                head, block, end = parse(source, at)
                row = describe(head, block)
                if damage and (row["record_type"] == "revisit" or "warc-payload-digest" not in head):
                    raise ValueError("record of a damaged member without a digest over its payload")
                break
            except ValueError as failed:
                reason, row = reason or str(failed), None
                at = candidate(source, at + 1, (VERSION,))
        if at > start and not damage:
            yield {"gap": f"{reason} (inflated bytes {start} to {at} of the member)"}
        if row is not None:
            yield row
            at = end


def take(view: Window, at: int) -> tuple[Iterator[dict], int, str]:
    """(rows, end, damage): the records that begin at byte `at`, those of one member or one plain record, and where they end."""
    if view.read(at, 3) == MAGIC:
        source, end, damage = inflate(view, at)
        rows, ahead = within(source, damage), []
        for row in rows:
            ahead.append(row)
            if not row["gap"]:
                return itertools.chain(ahead, rows), end, damage
        if damage or ahead:
            raise ValueError(damage or ahead[0]["gap"])
        return iter([]), end, damage
    head, block, end = parse(view, at)
    return iter([describe(head, block)]), end, ""


def candidate(source: Window | Inflated | Held, at: int, marks: tuple[bytes, ...] = (MAGIC, VERSION)) -> int:
    """The next byte from `at` on where one of `marks` stands, or the end."""
    while at < source.size:
        part = source.read(at, CHUNK)
        hits = [x for x in map(part.find, marks) if x >= 0]
        if hits:
            return at + min(hits)
        at += max(1, len(part) - len(VERSION) + 1) if at + len(part) < source.size else len(part)
    return source.size


def salvage(view: Window) -> Iterator[dict]:
    """Records and gaps of one file, in order; together they cover every byte."""
    at = 0
    while at < view.size:
        start, reason = at, ""
        while at < view.size:
            try:
                rows, end, damage = take(view, at)
                if not damage:
                    break
                if at > start:
                    yield {"offset": start, "length": at - start, "gap": reason}
                yield from (row | {"offset": at, "length": 0} for row in rows)
                start, reason = at, damage
            except ValueError as failed:
                reason = reason or str(failed)
            at = candidate(view, at + 1)
        if at > start:
            yield {"offset": start, "length": at - start, "gap": reason}
        if at < view.size:
            for row in rows:
                yield row | {"offset": at, "length": end - at}
            at = end


def read_archives(files: DataFrame, with_payload: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """Salvage the archives named in column `file`: one row per record, and one per gap (its `gap` says why).

    `with_payload` False leaves payloads out of the result; they are checked all the same. Memory
    holds one record, one chunk and one batch of rows.
    """
    columns = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["file"]:
                store, path = open_store(name)
                rows, held = [], 0
                with store.open_input_file(path) as source:
                    for row in salvage(Window(source, source.size())):
                        row["file"] = name
                        if not with_payload:
                            row["payload"] = None
                        rows.append([row.get(c) for c in columns])
                        held += 500 + len(row.get("payload") or b"")
                        if held >= batch_bytes:
                            yield frame(rows)
                            rows, held = [], 0
                yield frame(rows)

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns, dtype=object)
        for c in ("offset", "length", "page_id", "refers_to", "payload_bytes"):
            out[c] = out[c].astype("Int64")
        return out

    ship(files.sparkSession)
    return files.select("file").mapInPandas(read, RECORD_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write `pages` as archives and read them back: one row per page."""
    manifest = write_archives(pages, scratch(spark, "warc"), least)
    files = manifest.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "file")
    lost = F.raise_error(F.concat(F.lit("own archive has a gap: "), F.col("file"), F.lit(": "), F.col("gap"))).cast("boolean")
    return read_archives(files, with_payload=False).where(F.when(F.col("gap").isNull(), F.lit(True)).otherwise(lost))
