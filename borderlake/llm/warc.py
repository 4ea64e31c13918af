"""WARC archives with a two-level capture index.

Writing: pages with equal payloads are found by digest; the first becomes a response
record, the others revisit records that refer to it. Every task writes the records of its
pages, each compressed by itself, to archive files of its own; pages are not shuffled.

Index: captures are sorted by the URL key with its host reversed, range-partitioned so
that a host or URL with very many captures spreads over parts. A part is one file of
compressed blocks of BLOCK captures, followed by its directory: first and last key, place
and length of each block. The list of parts has a row for PART captures.

Reading: a key is binary-searched in the list of parts and then in a part's directory;
only blocks that may hold it are read, each by one range. The captures found give the
ranges of the records, which are read in the order of the archives.

Files are written and read through pyarrow's file systems in the shared folder. Names are
new for every attempt of a task, and only files named in the rows that a task returns
count, so lost or repeated tasks do no harm.

Defined cases: a null html is an empty payload; a null url has the empty key. A null
page_id counts as larger than any other when the first of equal payloads is chosen; of
repeated rows the first is the response. An empty table gives an empty index and result.
Other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PART_BIT, ROW, arrow_map, by_part, file_system, new_path, numbered, read_part, slices, stored, texts

#: Payloads below this size are always responses.
MIN_BYTES = 100
#: Captures in a block and in a part of the index; bytes at which a task begins another archive.
BLOCK, PART, ARCHIVE_BYTES = 3000, 1_000_000, 1 << 30
#: Ranges closer than this are read together, up to so many bytes.
NEAR, TOGETHER = 1 << 16, 8 << 20
#: Capture time, which the tables do not have.
DATE = "2000-01-01T00:00:00Z"
SPACE_ID = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

CAPTURE = (
    f"key string, page_id long, {ROW} long, url string, record_type string, refers_to long, "
    "digest string, payload_bytes long, archive string, begin long, length long"
)
NAMES = [field.split()[0] for field in CAPTURE.split(", ")]
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, verified boolean, payload binary"


def url_key(url: str | None) -> str:
    """The host with its labels reversed, then the path: com,example,www)/a?b."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    end = next((i for i, letter in enumerate(rest) if letter in "/?"), len(rest))
    host, _, port = rest[:end].rpartition("@")[2].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (rest[end:] or "/")


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_ID, f'{page_id} {row}')}>"


def record(page_id, row, url, payload: bytes, digest: str, first: tuple | None) -> bytes:
    """A WARC record, compressed by itself. ``first`` has the page_id and row of the response it revisits."""
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = status if first else status + payload
    fields = [
        ("WARC-Type", "revisit" if first else "response"),
        ("WARC-Record-ID", record_id(page_id, row)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Page-ID", "" if page_id is None else page_id),
        ("Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    if first:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields += [("WARC-Profile", profile), ("WARC-Refers-To", record_id(*first))]
        fields += [("Refers-To-Page-ID", "" if first[0] is None else first[0])]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    packer = zlib.compressobj(4, wbits=31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and payload of a compressed record."""
    head, _, block = zlib.decompress(data, wbits=31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def revisits(pages: DataFrame) -> str:
    """Rows whose payload an earlier row has, with that row; stored by partition of the pages."""
    html = F.coalesce("html", F.lit(""))
    hashed = numbered(pages, "page_id", "html").filter(F.octet_length(html) >= MIN_BYTES)
    hashed = hashed.select(F.col("page_id").cast("long").alias("page_id"), ROW, F.unhex(F.sha2(html, 256)).alias("digest"))
    first = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", ROW)
    firsts = hashed.groupBy("digest").agg(F.min(first).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    later = hashed.join(firsts, "digest").filter(F.col(ROW) != F.col(f"first.{ROW}"))
    return by_part(later.select(ROW, F.col("first.page_id").alias("first_id"), F.col(f"first.{ROW}").alias("first_row")), "revisits", ROW)


def write_archives(pages: DataFrame) -> DataFrame:
    """Write a record for every page; a stored table of the captures. ``pages`` must be a stored table."""
    folder, known = new_path(pages.sparkSession, "warc"), revisits(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at, firsts = None, "", 0, None
        for batch in slices(batches, 3):
            found = []
            if firsts is None:
                table = read_part(known, batch.column(1)[0].as_py() >> PART_BIT, [ROW, "first_id", "first_row"])
                rows = table.to_pydict() if table else {ROW: [], "first_id": [], "first_row": []}
                firsts = dict(zip(rows[ROW], zip(rows["first_id"], rows["first_row"], strict=True), strict=True))
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for page_id, row, url, payload in zip(*columns, texts(batch.column(3)), strict=True):
                if out is None:
                    system, path = file_system(folder)
                    system.create_dir(path, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                first, digest = firsts.get(row), hashlib.sha256(payload).hexdigest()
                data = record(page_id, row, url, payload, digest, first)
                out.write(data)
                kind, refers = ("revisit", first[0]) if first else ("response", None)
                found.append((url_key(url), page_id, row, url, kind, refers, digest, len(payload), f"{folder}/{name}", at, len(data)))
                at += len(data)
                if at > ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield captures(found)
        if out is not None:
            out.close()

    plain = numbered(pages, "page_id", "url", "html").select(F.col("page_id").cast("long").alias("page_id"), ROW, "url", "html")
    return stored(plain.mapInArrow(write, CAPTURE), "captures")


def captures(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    types = [kinds[field.split()[1]] for field in CAPTURE.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)


def build_index(found: DataFrame) -> DataFrame:
    """Write the index of stored captures; a stored table of its parts."""
    folder = new_path(found.sparkSession, "capture-index")
    order = ["key", "page_id", ROW]
    parts = max(1, math.ceil(found.count() / PART), int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, directory, out, at, total = [], [], None, 0, 0
        name = uuid.uuid4().hex

        def flush() -> None:
            nonlocal at, out
            if out is None:
                system, path = file_system(folder)
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}", compression=None)
            data = zlib.compress("\n".join(json.dumps(row) for row in waiting).encode())
            out.write(data)
            directory.append([waiting[0][0], waiting[-1][0], at, len(data)])
            at += len(data)
            waiting.clear()

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                waiting.append(row)
                total += 1
                if len(waiting) == BLOCK:
                    flush()
        if waiting:
            flush()
        if out is not None:
            data = zlib.compress(json.dumps(directory).encode())
            out.write(data)
            out.close()
            row = [f"{folder}/{name}", directory[0][0], directory[-1][1], at, len(data), total]
            names = ["file", "first_key", "last_key", "directory_begin", "directory_length", "captures"]
            yield pa.record_batch([pa.array([value]) for value in row], names=names)

    spread = found.select(NAMES).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = "file string, first_key string, last_key string, directory_begin long, directory_length long, captures long"
    return stored(spread.mapInArrow(write, schema), "index-parts")


def read_range(file: str, begin: int, length: int) -> bytes:
    system, path = file_system(file)
    with system.open_input_file(path) as source:
        return source.read_at(length, begin)


def overlap(first: list[str], last: list[str], key: str) -> range:
    """Of sorted intervals, those that may hold the key, by binary search."""
    return range(bisect.bisect_left(last, key), bisect.bisect_right(first, key))


def lookup(parts: DataFrame, keys: DataFrame) -> DataFrame:
    """The captures of the distinct URL keys in the column ``key``. ``parts``, the list made by
    ``build_index``, has a row for about PART captures and goes to every task."""
    listed = sorted((r["first_key"], r["last_key"], r["file"], r["directory_begin"], r["directory_length"]) for r in parts.collect())
    known = keys.sparkSession.sparkContext.broadcast(listed)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        first, last = [part[0] for part in known.value], [part[1] for part in known.value]
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                for i in overlap(first, last, key):
                    if i not in held:
                        held = {n: d for n, d in held.items() if n >= i - 1}  # keys come in order
                        directory = json.loads(zlib.decompress(read_range(*known.value[i][2:])))
                        held[i] = directory, [d[0] for d in directory], [d[1] for d in directory]
                    directory, firsts, lasts = held[i]
                    found += [(key, known.value[i][2], *directory[b][2:]) for b in overlap(firsts, lasts, key)]
            if found:
                yield pa.record_batch([pa.array(c) for c in zip(*found, strict=True)], names=["key", "file", "begin", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows, firsts = None, [], []
        for batch in batches:
            found = []
            for key, *here in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if here != place:
                    place, rows = here, [json.loads(line) for line in zlib.decompress(read_range(*here)).split(b"\n")]
                    firsts = [row[0] for row in rows]
                found += rows[bisect.bisect_left(firsts, key) : bisect.bisect_right(firsts, key)]
            yield captures(found)

    wanted = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    blocks = wanted.mapInArrow(locate, "key string, file string, begin long, length long")
    spread = blocks.repartition("file", "begin").sortWithinPartitions("file", "begin", "key")
    return spread.mapInArrow(read, CAPTURE)


def read_records(found: DataFrame) -> DataFrame:
    """Read the records of captures by ranges of the archives, check their digests, and return
    what is in them. The payload of a revisit is null; its size and digest are those it names."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(column.to_pylist() for column in batch.columns), strict=True))
            at = 0
            while at < len(rows):
                name, begin, length = rows[at]
                end, last = begin + length, at + 1
                while last < len(rows) and rows[last][0] == name and rows[last][1] - end < NEAR and rows[last][1] + rows[last][2] - begin < TOGETHER:
                    end = rows[last][1] + rows[last][2]
                    last += 1
                data = read_range(name, begin, end - begin)
                yield opened([data[b - begin : b - begin + n] for _, b, n in rows[at:last]])
                at = last

    near = F.floor(F.col("begin") / TOGETHER)
    spread = found.select("archive", "begin", "length").repartition("archive", near).sortWithinPartitions("archive", "begin")
    return spread.mapInArrow(read, RECORD)


def opened(records: list[bytes]) -> pa.RecordBatch:
    found = []
    for fields, payload in map(parse, records):
        digest, whole = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"] == "response"
        good = not whole or (hashlib.sha256(payload).hexdigest() == digest and len(payload) == int(fields["Payload-Length"]))
        number = {name: int(fields[name]) if fields.get(name) else None for name in ("Page-ID", "Refers-To-Page-ID")}
        row = (number["Page-ID"], fields["WARC-Target-URI"], fields["WARC-Type"], number["Refers-To-Page-ID"])
        found.append((*row, int(fields["Payload-Length"]), digest, good, payload if whole else None))
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "verified", "payload"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)


def url_keys(pages: DataFrame) -> DataFrame:
    """The key of every page's URL."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([pa.array([url_key(url) for url in batch.column(0).to_pylist()], pa.string())], names=["key"])

    return arrow_map(pages.select("url"), "key string", run, "url")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives, index them, look up every URL, and read the records back."""
    parts = build_index(write_archives(pages))
    return read_records(lookup(parts, url_keys(pages)))
