"""WARC archives with a two-level capture index.

Archives are files of one gzip member per record. The index holds a line per capture, sorted by
the URL with its host reversed; lines lie in compressed blocks, and a sparse directory has the
first key of each block. A look-up finds a block by binary search and reads only ranges of files.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_path, saved

#: Lines of a block of the index.
BLOCK_LINES = 512
#: Neighbouring records are read together up to so many bytes.
READ_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"

CAPTURE = "url_key string, url string, page_id bigint, archive string, start bigint, length bigint, payload_bytes bigint, digest string, record_type string, refers_to bigint"
DIRECTORY = "shard string, first_key string, last_key string, start bigint, length bigint, n_lines bigint"
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
FIELDS = [x.split()[0] for x in CAPTURE.split(", ")]


def url_key(url: str | None) -> str:
    """The host's labels reversed, then the path and query: com,example,www)/a?b=1. Scheme, port, user and fragment are left out."""
    try:
        parts = urlsplit(url or "")
        host = parts.hostname or ""
    except ValueError:
        return url or ""
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def _files(root: str) -> tuple[fs.FileSystem, str]:
    files, path = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
    return files, path


def _head(kind: str, lines: list[tuple[str, object]], block: bytes) -> bytes:
    fields = [("WARC-Type", kind), *lines, ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record(page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """A response record, or the revisit of an equal payload, which holds none."""
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", clean),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Page-ID", "" if page_id is None else page_id),
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Page-ID", refers_to)]
        return _head("revisit", [*fields, ("Content-Type", "application/http; msgtype=response")], http)
    return _head("response", [*fields, ("Content-Type", "application/http; msgtype=response")], http + payload)


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """The fields of one record, its HTTP head and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, http, payload


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Archives of pages (page_id, url, html) in a shared folder; gives the captures written, one for each row.

    Of rows with equal payloads (html in UTF-8; null counts as empty) of at least least_bytes, the
    one with the smallest page_id becomes a response and the others revisits of it; shorter ones
    are all responses. Repeated rows of that smallest page_id are all responses; so are rows
    without a page_id if no row of that payload has one. Other columns are ignored.

    A task writes a file of a name of its own and reports it with its rows, so the files of lost or
    repeated tasks are never read. Payloads of revisits aren't written.
    """
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    first = rows.where(F.octet_length("html") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = (F.col("first") != F.col("page_id")) | (F.col("first").isNotNull() & F.col("page_id").isNull())
    rows = rows.join(first, "sha", "left").select("page_id", "url", "html", "sha", F.when(again, F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        out, name, at = None, f"{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            made: list[tuple] = []
            for page_id, url, html, sha, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    info = _gzip(_head("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    out.write(info)
                    at = len(info)
                payload = html.encode("utf-8", "surrogatepass")
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                data = _gzip(record(page_id, url, payload, digest, refers_to))
                out.write(data)
                made.append((url_key(url), url, page_id, name, at, len(data), len(payload), digest, "response" if refers_to is None else "revisit", refers_to))
                at += len(data)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), _TYPES, strict=True)], names=FIELDS)
        if out is not None:
            out.close()

    return saved(rows.mapInArrow(run, CAPTURE), "captures")


_TYPES = [pa.string() if x.split()[1] == "string" else pa.int64() for x in CAPTURE.split(", ")]


def index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the index of captures and gives its directory: a row for each block.

    Lines are sorted by URL key over all shards: a range of keys each, split further by page_id, so
    that a very common host or URL fills several shards. Each shard has a file of compressed blocks
    and a small one with its part of the directory.
    """
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = captures.repartitionByRange(n, "url_key", "page_id").sortWithinPartitions("url_key", "page_id", "archive", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        shard, at, made, waiting, out = uuid.uuid4().hex, 0, [], [], None

        def block(rows: list[dict]) -> None:
            nonlocal at, out
            out = out or files.open_output_stream(f"{root}/{shard}.cdx.gz", compression=None)
            data = _gzip("".join(json.dumps([r[f] for f in FIELDS]) + "\n" for r in rows).encode())
            out.write(data)
            made.append((shard, rows[0]["url_key"], rows[-1]["url_key"], at, len(data), len(rows)))
            at += len(data)

        for batch in batches:
            waiting += batch.to_pylist()
            while len(waiting) >= block_lines:
                block(waiting[:block_lines])
                waiting = waiting[block_lines:]
        if waiting:
            block(waiting)
        if out is None:
            return
        out.close()
        with files.open_output_stream(f"{root}/{shard}.idx", compression=None) as f:
            f.write(json.dumps(made).encode())
        kinds = [pa.string()] * 3 + [pa.int64()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=[x.split()[0] for x in DIRECTORY.split(", ")])

    return saved(lines.mapInArrow(run, DIRECTORY), "directory")


def _lines(files: fs.FileSystem, path: str, start: int, length: int) -> list[list]:
    with files.open_input_file(path) as f:
        return [json.loads(x) for x in zlib.decompress(f.read_at(length, start), 31).splitlines()]


def captures_of(directory: DataFrame, folder: str) -> DataFrame:
    """All lines of the index, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        for batch in batches:
            for b in batch.to_pylist():
                rows = _lines(files, f"{root}/{b['shard']}.cdx.gz", b["start"], b["length"])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=FIELDS)

    return directory.mapInArrow(run, CAPTURE)


def read(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records at the captures' places: fields as they stand in the archives, length and digest as computed from the payload read.

    A revisit has the length and digest of the payload that it refers to, as its HTTP head and
    fields say. Captures are dealt out by archive and place, so neighbours are read in one range.
    """
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = captures.select("archive", "start", "length").repartitionByRange(n, "archive", "start").sortWithinPartitions("archive", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        for batch in batches:
            for archive, ranges in _ranges(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                start, stop = ranges[0][0], max(s + n for s, n in ranges)
                with files.open_input_file(f"{root}/{archive}") as f:
                    data = f.read_at(stop - start, start)
                made = [_told(zlib.decompress(data[s - start : s - start + n], 31), payloads) for s, n in ranges]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=[x.split()[0] for x in RECORD.split(", ")])

    return places.mapInArrow(run, RECORD)


def _ranges(places) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Places in order, in groups that lie near each other in one archive."""
    name, group = None, []
    for archive, start, length in places:
        if group and (archive != name or start > group[-1][0] + group[-1][1] + 65536 or start + length - group[0][0] > READ_BYTES):
            yield name, group
            group = []
        name = archive
        group.append((start, length))
    if group:
        yield name, group


def _told(data: bytes, payloads: bool) -> tuple:
    fields, http, payload = parse(data)
    number = lambda x: int(x) if x else None
    kind = fields["WARC-Type"]
    if kind == "revisit":
        size = int(http.decode().rpartition("Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    else:
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return number(fields["WARC-Page-ID"]), fields["WARC-Target-URI"], size, digest, kind, number(fields.get("WARC-Refers-To-Page-ID", "")), payload if payloads and kind == "response" else None


def look_up(urls: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """The captures of the URLs in the column url, each once. A null URL finds nothing."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(url_key, batch.column(0).to_pylist()), pa.string())], names=["url_key"])

    return search(urls.where("url IS NOT NULL").select(F.col("url").cast("string")).distinct().mapInArrow(keyed, "url_key string"), directory, folder)


def search(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """The captures of the keys in the column url_key, each once, by the two levels of the index.

    The driver holds the key range of every shard (as many as partitions when the index was made).
    Look-ups are dealt out by shard; a task reads the directory of a shard once, finds the blocks
    of a key by binary search and reads only those. Lines of one key, however many, leave block by
    block.
    """
    ranges = sorted(tuple(r) for r in directory.groupBy("shard").agg(F.min("first_key"), F.max("last_key")).select("min(first_key)", "max(last_key)", "shard").collect())
    # largest key of the shards up to each, as shards that share a very common key overlap
    firsts_of, reach = [r[0] for r in ranges], list(accumulate((r[1] for r in ranges), max))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                at = bisect.bisect_right(firsts_of, key) - 1
                while at >= 0 and reach[at] >= key:
                    if ranges[at][1] >= key:
                        found.append((key, ranges[at][2]))
                    at -= 1
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], names=["url_key", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        shard, blocks, firsts, cached, hits = None, [], [], (None, []), []
        for batch in batches:
            for key, of in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != shard:
                    shard = of
                    with files.open_input_file(f"{root}/{shard}.idx") as f:
                        blocks = json.loads(f.read())
                    firsts = [b[1] for b in blocks]
                at = max(0, bisect.bisect_left(firsts, key) - 1)
                while at < len(blocks) and firsts[at] <= key:
                    if cached[0] != (shard, at):
                        cached = ((shard, at), _lines(files, f"{root}/{shard}.cdx.gz", blocks[at][3], blocks[at][4]))
                    lines = cached[1]
                    lo, hi = (side(lines, key, key=lambda x: x[0]) for side in (bisect.bisect_left, bisect.bisect_right))
                    hits += lines[lo:hi]
                    at += 1
                    if len(hits) >= BLOCK_LINES:
                        yield told(hits)
                        hits = []
        if hits:
            yield told(hits)

    def told(hits: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hits, strict=True), _TYPES, strict=True)], names=FIELDS)

    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select("url_key").distinct().mapInArrow(shards, "url_key string, shard string")
    return dealt.repartitionByRange(n, "shard", "url_key").sortWithinPartitions("shard", "url_key").mapInArrow(run, CAPTURE)


def folder_for(spark: SparkSession) -> str:
    """A new shared folder for archives and index."""
    root = new_path(spark, "warc")
    files, path = _files(root)
    files.create_dir(path, recursive=True)
    return root


def write_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written as archives with an index, then every URL key looked up in it and its records read: (page_id, payload_bytes, payload_digest, record_type, refers_to). Jobs run when this is called."""
    folder = folder_for(pages.sparkSession)
    captures = write(pages, folder, least_bytes)
    found = search(captures.select("url_key"), index(captures, folder), folder)
    return read(found, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
