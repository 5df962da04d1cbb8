"""WARC archives with a two-level capture index, written and read by Spark tasks.

Writing: each task appends records to archives of bounded size, one gzip member per record, and reports url key, file,
offset and length. An archive's name is new in every attempt, so a repeated task leaves at most an unnamed file behind;
the reported rows are written once and are the truth. Records of equal payloads of ``least_revisit`` bytes or more are
stored once, in the record with the largest id; the others are revisits that name it and carry its digest and length.

Index: captures are sorted by reversed-host key over all partitions and cut into compressed blocks of ``block`` lines;
each index file holds its blocks and then a directory of first keys. ``Part`` rows (one per index file) are the level above.

Reading: each task takes a range of sorted keys, finds the index file and then the block by binary search, reads that
range, and reads the record's range from its archive. Folders may lie on any file system that pyarrow opens on executors.

Null payloads count as empty, null urls as empty urls with key ")/" ; null ids are written as empty names and read back as
null. Repeated rows and equal ids are records of their own; extra columns are left aside.
Of equal payloads the largest id is the response; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.common import texts_of
from tallycart.session import scratch, staged

DATE = "2024-01-01T00:00:00Z"
#: Bytes of archives that one task reads back: at most, and at least while cores are left.
READ_MOST, READ_LEAST = 64 << 20, 2 << 20


@dataclass(frozen=True)
class Settings:
    archive_bytes: int = 64 << 20
    block: int = 500
    least_revisit: int = 1000


def url_key(url: str | None) -> str:
    """Host reversed and comma-joined, then port, path and query: ``org,example,www)/a?b``. Scheme and fragment go."""
    rest = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or "").split("#")[0]
    m = re.match(r"(?:[^/?@]*@)?([^/?:]*)(:[0-9]*)?(.*)", rest, re.DOTALL)
    host, port, path = m.group(1).lower(), m.group(2) or "", m.group(3)
    path = path if path.startswith("/") else "/" + path
    return (",".join(reversed(host.split("."))) + port + ")" + path).replace("\n", "%0A").replace("\r", "%0D").replace(" ", "%20")


def folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, refers_url: str | None) -> bytes:
    """A response, or a revisit with the response's HTTP head only. The digest is SHA-1 in hex, written in base 32."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    clean = lambda x: re.sub(r"[\r\n]+", " ", x or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    body = head + payload
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>",
                  f"WARC-Refers-To-Target-URI: {clean(refers_url)}", f"WARC-Refers-To-Date: {DATE}"]
        body = head
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """A record's headers, payload bytes and the length that its HTTP head states."""
    top, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in top.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: ([0-9]+)", http).group(1))
    return {"fields": fields, "payload": payload, "length": length}


def gzipped(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def with_revisits(pages: DataFrame, settings: Settings) -> DataFrame:
    """Pages with their payload digest, and the id and url of the response that a revisit refers to."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.withColumn("digest", F.sha1(payload.cast("binary"))).withColumn("size", F.octet_length(payload))
    equal = rows.where((F.col("size") >= settings.least_revisit) & F.col("page_id").isNotNull()).groupBy("digest", "size")
    first = F.max(F.struct("page_id", "url")).alias("kept")
    shared = staged(equal.agg(first, F.count("*").alias("n")).where("n > 1"), "shared-payloads")
    rows = rows.join(shared.select("digest", "size", "kept"), ["digest", "size"], "left")
    other = F.col("kept").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("kept.page_id"))
    return rows.select(
        "page_id", "url", "html", "digest", F.when(other, F.col("kept.page_id")).alias("refers_to"), F.when(other, F.col("kept.url")).alias("refers_url")
    )


def write_archives(pages: DataFrame, path: str, settings: Settings) -> DataFrame:
    """Write the records; the captures (key, page_id, file, offset, length), already written as a table."""
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = folder(path)
        where.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            urls, texts = batch.column("url").to_pylist(), texts_of(batch.column("html"))
            ids, digests, to, to_url = (batch.column(c).to_pylist() for c in ("page_id", "digest", "refers_to", "refers_url"))
            for k, text in enumerate(texts):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, at = where.open_output_stream(f"{root}/{name}", compression=None), 0
                data = gzipped(record(ids[k], urls[k], text.encode("utf-8", "surrogatepass"), digests[k], to[k], to_url[k]))
                out.write(data)
                rows.append((url_key(urls[k]), name, at, len(data)))
                at += len(data)
                if at >= settings.archive_bytes:
                    out.close()
                    out = None
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([made[0], batch.column("page_id"), *made[1:]], ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return staged(pages.mapInArrow(run, f"key string, page_id {kind}, file string, offset long, length long"), "captures")


def write_index(captures: DataFrame, path: str, settings: Settings) -> DataFrame:
    """Write the index files; one row per file: its name, its first entry, where its directory begins and ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = folder(path)
        where.create_dir(root, recursive=True)
        name, out, at, directory, lines, first = f"{uuid.uuid4().hex}.cdx", None, 0, [], [], None

        def flush() -> None:
            nonlocal at
            data = zlib.compress("\n".join(lines).encode("utf-8", "surrogatepass"))
            out.write(data)
            directory.append((lines[0].rsplit(" ", 1)[0], at, len(data)))
            at += len(data)
            lines.clear()

        for batch in batches:
            for key, file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset", "length")), strict=True):
                out = out or where.open_output_stream(f"{root}/{name}", compression=None)
                first = first or f"{key} {file} {offset:015d}"
                lines.append(f"{key} {file} {offset:015d} {length}")
                if len(lines) >= settings.block:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        listed = zlib.compress(json.dumps(directory).encode())
        out.write(listed)
        out.close()
        row = [pa.array([x], t) for x, t in ((name, pa.string()), (first, pa.string()), (at, pa.int64()), (len(listed), pa.int64()))]
        yield pa.RecordBatch.from_arrays(row, ["index", "first", "offset", "length"])

    placed = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset").select("key", "file", "offset", "length")
    return staged(placed.mapInArrow(run, "index string, first string, offset long, length long"), "index-parts")


class Lookup:
    """Finds captures in the index files and reads their records; holds one index block and a few open files."""

    def __init__(self, archives: str, index: str, parts: list[tuple[str, str, int, int]]):
        self.parts = sorted(parts, key=lambda p: p[1].split(" "))
        self.firsts = [p[1].split(" ") for p in self.parts]
        self.where, self.archives = folder(archives)
        self.index = folder(index)[1]
        self.opened = lru_cache(maxsize=16)(self.where.open_input_file)
        self.directory = lru_cache(maxsize=4)(self._directory)
        self.block = lru_cache(maxsize=4)(self._block)

    def read(self, path: str, offset: int, length: int) -> bytes:
        file = self.opened(path)
        file.seek(offset)
        return file.read(length)

    def _directory(self, part: int) -> tuple[list[list[str]], list[tuple[str, int, int]]]:
        name, _, offset, length = self.parts[part]
        entries = json.loads(zlib.decompress(self.read(f"{self.index}/{name}", offset, length)))
        return [e[0].split(" ") for e in entries], entries

    def _block(self, part: int, number: int) -> list[list[str]]:
        _, offset, length = self.directory(part)[1][number]
        data = zlib.decompress(self.read(f"{self.index}/{self.parts[part][0]}", offset, length))
        return [line.split(" ") for line in data.decode("utf-8", "surrogatepass").split("\n")]

    def captures(self, key: str) -> Iterator[tuple[str, int, int]]:
        """All captures of a key, in the order of file and offset."""
        yield from self.captures_from([key])

    def captures_from(self, start: list[str]) -> Iterator[tuple[str, int, int]]:
        """Captures of the key in ``start`` from the given file and offset on."""
        key = start[0]
        part = max(0, bisect.bisect_right(self.firsts, start) - 1)
        while part < len(self.parts):
            firsts, entries = self.directory(part)
            number = max(0, bisect.bisect_right(firsts, start) - 1)
            while number < len(entries):
                lines = self.block(part, number)
                for line in lines[bisect.bisect_left(lines, start) :]:
                    if line[0] != key:
                        return
                    yield line[1], int(line[2]), int(line[3])
                number += 1
            part += 1
            if part < len(self.parts) and self.firsts[part][0] > key:
                return

    def record(self, file: str, offset: int, length: int) -> dict:
        return parsed(zlib.decompress(self.read(f"{self.archives}/{file}", offset, length), 31))


def read_archives(wanted: DataFrame, archives: str, index: str, parts: DataFrame) -> DataFrame:
    """The records of the wanted captures (key, file, offset), found through the index. The list of index files has one
    row per file and is bounded by the number of partitions that wrote it."""
    sent = wanted.sparkSession.sparkContext.broadcast([tuple(r) for r in parts.select("index", "first", "offset", "length").collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(archives, index, sent.value)
        for batch in batches:
            rows = []
            for key, file, offset in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset")), strict=True):
                found = next(lookup.captures_from([key, file, f"{offset:015d}"]), None)
                if found is None or found[:2] != (file, offset):
                    raise ValueError(f"no capture of {key} at {file} {offset} in the index")
                r = lookup.record(*found)
                f = r["fields"]
                digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                if f["warc-type"] == "response" and (hashlib.sha1(r["payload"]).hexdigest() != digest or len(r["payload"]) != r["length"]):
                    raise ValueError(f"damaged record of {key} at {file} {offset}")
                name = lambda x: re.sub(r"^<urn:page:|>$", "", x) or None if x is not None else None
                rows.append((name(f["warc-record-id"]), r["length"], digest, f["warc-type"], name(f.get("warc-refers-to"))))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            )

    # a pointer is small and its record is not: the archives' bytes ask for the tasks
    size = wanted.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-size // READ_MOST), min(wanted.sparkSession.sparkContext.defaultParallelism, -(-size // READ_LEAST)))
    placed = wanted.repartitionByRange(tasks, "key", "file", "offset").sortWithinPartitions("key", "file", "offset").select("key", "file", "offset")
    return placed.mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", path: str | None = None, settings: Settings | None = None) -> DataFrame:
    """Write all pages as WARC with its index below ``path`` (a new shared folder by default) and read them back."""
    s = settings or Settings()
    path = path or scratch(pages.sparkSession, "warc")
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = dict(slim.dtypes)["page_id"]
    captures = write_archives(with_revisits(slim, s), f"{path}/archives", s)
    parts = write_index(captures, f"{path}/index", s)
    back = read_archives(captures, f"{path}/archives", f"{path}/index", parts)
    return back.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
