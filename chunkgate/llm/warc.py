"""WARC archives of pages, and a two-level capture index to read single records back.

Writing. Each page becomes a WARC/1.1 record in a gzip member of its own. Of records with equal payloads the
one with the smallest page_id is a response with the payload, the others are revisits that refer to it and
hold the HTTP header alone. An archive is what one task writes: a warcinfo record and then records, kept in
blocks of bounded size as rows of a Parquet table, so that it can lie in any store and a lost task leaves
nothing half written. The blocks of an archive, one after another, are the bytes of a .warc.gz file.

Indexing. A capture's key is its URL with the host reversed ("org,example,www)/path"), so that pages of a
site and its subdomains lie together. Captures are range-partitioned and sorted by key and place and packed
into compressed blocks of ``BLOCK_CAPTURES``. The directory has one entry for each block, its first and its
last key; of it, at most ``TOP_ENTRIES`` first keys, cut to ``TOP_CHARS``, are held in memory.

Reading. A wanted key is looked for by binary search in the held keys, which gives the run of directory entries
that can hold it; the entries' own keys then name the blocks. A block is opened once for all keys wanted
from it. The captures found give archive, block, offset and length of records, and these ranges alone are
unpacked from the archives.

Defined results: a null payload is empty. Rows that share page_id and payload with a response are responses
too (a record cannot refer to itself). Rows without a page_id come after all others: they revisit one with an
id, and are responses where there is none. A null or empty URL has the empty key and no target header; control
characters, blanks and non-ASCII characters in URLs are percent-encoded. An empty table gives no archives.
Extra columns are ignored. ``least`` is the size from which payloads are compared.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkgate.llm.words import slices
from chunkgate.sources.tables import stored

#: A block of an archive is closed by the record that brings it to so many bytes.
BLOCK_BYTES = 1 << 20
#: Captures in a block of the index.
BLOCK_CAPTURES = 4096
#: Keys of the directory held in memory, and characters of each.
TOP_ENTRIES, TOP_CHARS = 1 << 16, 200
#: Keys wanted from one block that one task looks for.
WANTED_KEYS = 1 << 14
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
#: Packed rows are turned into Python objects so many at a time.
_ROWS = 256

# What the WARC standard calls a revisit of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SOFTWARE = b"software: chunkgate\r\nformat: WARC File Format 1.1\r\n"

ARCHIVES = "archive long, block int, data binary, captures array<struct<key:string,page_id:long,offset:long,length:long>>"
_CAPTURES = pa.list_(pa.struct([("key", pa.string()), ("page_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]))
INDEX = "shard int, block int, n long, first_key string, last_key string, data binary"
PLACES = "key string, archive long, block int, offset long, length long"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


# Keys and records ----------------------------------------------------------------------


def capture_key(url: str | Column) -> Column:
    """The URL with its host reversed and without scheme, user, port 80 or 443 and fragment; empty for none."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?(\[[^\]/]*\]|[^/?#:]*)(:[0-9]*)?([^#]*)"
    host = F.lower(F.regexp_extract(url, pattern, 1))
    port, rest = F.regexp_extract(url, pattern, 2), F.regexp_extract(url, pattern, 3)
    turned = F.when(host.rlike(r"^(\[.*|[0-9.]+)$"), host).otherwise(F.array_join(F.reverse(F.split(host, r"\.")), ","))
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    key = F.concat(turned, F.when(port.isin("", ":", ":80", ":443"), F.lit("")).otherwise(port), F.lit(")"), path)
    return F.when(url.rlike(pattern), key).otherwise(F.regexp_replace(url, "#.*$", ""))


def _target(url: str | None) -> str | None:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else None


def record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """The bytes of one WARC record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{name}: {value}" for name, value in headers if value is not None], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def urn_page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def sha1_label(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def http_header(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


def response(page_id: int | None, url: str | None, payload: bytes, digest: str, date: str) -> bytes:
    return record("response", [
        ("WARC-Record-ID", page_urn(page_id)), ("WARC-Date", date), ("WARC-Target-URI", _target(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ], http_header(len(payload)) + payload)


def revisit(page_id: int | None, url: str | None, n_bytes: int, digest: str, refers_to: int, date: str) -> bytes:
    return record("revisit", [
        ("WARC-Record-ID", page_urn(page_id)), ("WARC-Date", date), ("WARC-Target-URI", _target(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", page_urn(refers_to)), ("WARC-Profile", PROFILE), ("Content-Type", "application/http;msgtype=response"),
    ], http_header(n_bytes))


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


# Writing -------------------------------------------------------------------------------


def _member(data: bytes, level: int) -> bytes:
    return gzip.compress(data, level, mtime=0)


def _page_rows(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), capture_key("url").alias("key"),
        F.octet_length(html).cast("long").alias("n_bytes"), F.unhex(F.sha2(html, 256)).alias("identity"),
    )


def packed_responses(rows: DataFrame, date: str = DATE, level: int = LEVEL) -> DataFrame:
    """Each page as a compressed response, which is what is shuffled from here on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                ids, urls = part.column("page_id").to_pylist(), part.column("url").to_pylist()
                payloads = part.column("html").cast(pa.binary()).to_pylist()
                digests = [sha1_label(p) for p in payloads]
                members = [_member(response(i, u, p, d, date), level) for i, u, p, d in zip(ids, urls, payloads, digests)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("page_id", "url", "key", "n_bytes", "identity")] + [pa.array(digests), pa.array(members, pa.binary())],
                    ["page_id", "url", "key", "n_bytes", "identity", "digest", "member"],
                )

    return rows.mapInArrow(run, "page_id long, url string, key string, n_bytes long, identity binary, digest string, member binary")


def repeated_payloads(rows: DataFrame, least: int = 0) -> DataFrame:
    """The payloads that occur more than once, each with ``first``, the smallest page_id that has it."""
    groups = rows.where(F.col("n_bytes") >= least).groupBy("identity").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    return groups.where("copies > 1 and first is not null").select(F.col("identity").alias("_same"), "first")


def with_first(packed: DataFrame, repeats: DataFrame) -> DataFrame:
    """Add ``refers_to``, the page that a row repeats, and drop the members of those rows."""
    joined = packed.join(repeats, F.col("identity") == F.col("_same"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).select(
        "page_id", "url", "key", "n_bytes", "digest", "refers_to", F.when(F.col("refers_to").isNull(), F.col("member")).alias("member")
    )


def pack_archives(rows: DataFrame, date: str = DATE, level: int = LEVEL, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The archives, block by block, with the captures that lie in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, block = TaskContext.get().partitionId(), 0
        members, captures, size = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal block, members, captures, size
            out = pa.RecordBatch.from_arrays(
                [pa.array([archive], pa.int64()), pa.array([block], pa.int32()), pa.array([b"".join(members)], pa.binary()), pa.array([captures], _CAPTURES)],
                ["archive", "block", "data", "captures"],
            )
            block, members, captures, size = block + 1, [], [], 0
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                for row in batch.slice(at, _ROWS).to_pylist():
                    if not block and not members:
                        info = record("warcinfo", [
                            ("WARC-Record-ID", f"<urn:archive:{archive}>"), ("WARC-Date", date), ("WARC-Filename", f"{archive:08d}.warc.gz"), ("Content-Type", "application/warc-fields"),
                        ], SOFTWARE)
                        members, size = [member := _member(info, level)], len(member)
                    member = row["member"]
                    if member is None:
                        member = _member(revisit(row["page_id"], row["url"], row["n_bytes"], row["digest"], row["refers_to"], date), level)
                    captures.append((row["key"], row["page_id"], size, len(member)))
                    members.append(member)
                    size += len(member)
                    if size >= block_bytes:
                        yield close()
        if members:
            yield close()

    return rows.mapInArrow(run, ARCHIVES)


def write_archives(pages: DataFrame, path: str, least: int = 0, date: str = DATE, level: int = LEVEL) -> DataFrame:
    """Write the archives of a table of page_id, url, html to a shared folder and return them as read from there."""
    rows = _page_rows(pages)
    repeats = stored(repeated_payloads(rows, least), "repeated-payloads")
    pack_archives(with_first(packed_responses(rows, date, level), repeats), date, level).write.option("compression", "none").parquet(path)
    return open_archives(pages.sparkSession, path)


def open_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARCHIVES).parquet(path)


# The index -----------------------------------------------------------------------------


@dataclass
class CaptureIndex:
    """The blocks as a table, and the held part of the directory: the first keys of its runs, in order."""

    blocks: DataFrame
    run_entries: int
    keys: list[bytes]
    runs: list[tuple[int, int]]


def pack_captures(captures: DataFrame, block_captures: int = BLOCK_CAPTURES) -> DataFrame:
    """Blocks of sorted captures; ``shard`` and ``block`` number them in the order of their keys."""
    fields = ["key", "page_id", "archive", "block", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, held, n = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, held, n
            rows = pa.Table.from_batches(held).combine_chunks()
            data = zlib.compress(json.dumps([rows.column(c).to_pylist() for c in fields], separators=(",", ":")).encode(), LEVEL)
            keys = rows.column("key")
            out = pa.RecordBatch.from_pylist([{
                "shard": shard, "block": number, "n": n, "first_key": keys[0].as_py(), "last_key": keys[-1].as_py(), "data": data,
            }], schema=_INDEX)
            number, held, n = number + 1, [], 0
            return out

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, block_captures - n)
                held.append(piece)
                at, n = at + piece.num_rows, n + piece.num_rows
                if n == block_captures:
                    yield close()
        if n:
            yield close()

    order = ["key", "archive", "block", "offset"]  # places are distinct, so that many captures of one key part as others do
    return captures.select(*fields).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, INDEX)


_INDEX = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n", pa.int64()), ("first_key", pa.string()), ("last_key", pa.string()), ("data", pa.binary())])


def write_index(archives: DataFrame, path: str, block_captures: int = BLOCK_CAPTURES) -> None:
    """Index all captures of the archives; only the ``captures`` column of these is read."""
    captures = archives.select("archive", "block", F.explode("captures").alias("c")).select("c.key", "c.page_id", "archive", "block", "c.offset", "c.length")
    pack_captures(captures, block_captures).write.option("compression", "none").parquet(path)


def open_index(spark: SparkSession, path: str, top_entries: int = TOP_ENTRIES) -> CaptureIndex:
    """Hold the first key of each run of blocks: one block a run, or as many as leave ``top_entries`` runs."""
    blocks = spark.read.schema(INDEX).parquet(path)
    each = max(1, -(-blocks.count() // top_entries))
    first = blocks.groupBy("shard", F.floor(F.col("block") / each).cast("int").alias("run")).agg(F.min("first_key").alias("first"))
    top = sorted(tuple(r) for r in first.select("shard", "run", F.substring("first", 1, TOP_CHARS)).collect())
    return CaptureIndex(blocks, each, [k.encode() for _, _, k in top], [(s, r) for s, r, _ in top])


def _search(held: list[bytes], key: bytes, after: bool) -> int:
    """How many held keys are below the key, or with ``after`` not above it."""
    low, high = 0, len(held)
    while low < high:
        middle = (low + high) // 2
        if held[middle] < key or after and held[middle] == key:
            low = middle + 1
        else:
            high = middle
    return low


def _run_range(held: list[bytes], key: str) -> tuple[int, int]:
    """First and last run that can hold a key. Held keys are cut, so a run that begins like the key stays open on both sides."""
    whole = key.encode()
    cut = key[:TOP_CHARS].encode()
    return max(_search(held, cut, False) - 1, 0), _search(held, whole, True) - 1


def find_blocks(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """(key, shard, block) of the blocks of the index that can hold each of some distinct keys."""
    held, runs = index.keys, index.runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, *runs[r]) for k, (a, b) in ((k, _run_range(held, k)) for k in batch.column("key").to_pylist()) for r in range(a, b + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.int32())],
                ["key", "shard", "run"],
            )

    candidates = keys.select("key").mapInArrow(run, "key string, shard int, run int")
    directory = index.blocks.select("shard", "block", "first_key", "last_key", F.floor(F.col("block") / index.run_entries).cast("int").alias("run"))
    return candidates.join(directory, ["shard", "run"]).where("key >= first_key and key <= last_key").select("key", "shard", "block")


def look_up(index: CaptureIndex, keys: DataFrame, wanted_keys: int = WANTED_KEYS) -> DataFrame:
    """The places of all captures of the wanted keys (a column ``key``; repeats count once): key, archive, block, offset, length."""
    wanted = stored(find_blocks(index, keys.select("key").where("key is not null").distinct()), "wanted-keys")
    sizes = stored(wanted.groupBy("shard", "block").agg(F.ceil(F.count(F.lit(1)) / wanted_keys).cast("int").alias("shares")), "wanted-blocks")
    dealt = wanted.join(sizes, ["shard", "block"]).withColumn("share", F.pmod(F.xxhash64("key"), F.col("shares")).cast("int"))
    asked = dealt.groupBy("shard", "block", "share").agg(F.collect_list("key").alias("keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                asked_for = set(batch.column("keys")[k].as_py())
                key, _, archive, block, offset, length = json.loads(zlib.decompress(batch.column("data")[k].as_py()))
                at = [i for i, name in enumerate(key) if name in asked_for]
                columns = [[values[i] for i in at] for values in (key, archive, block, offset, length)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PLACES.types)], _PLACES.names)

    return index.blocks.select("shard", "block", "data").join(asked, ["shard", "block"]).select("data", "keys").mapInArrow(run, PLACES)


_PLACES = pa.schema([("key", pa.string()), ("archive", pa.int64()), ("block", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])


# Reading -------------------------------------------------------------------------------


def _read(member: bytes) -> dict:
    headers, block = parse(gzip.decompress(member))
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(next(line.partition(b": ")[2] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length: ")))
    if kind == "response" and (len(payload) != size or sha1_label(payload) != digest):
        raise ValueError(f"the payload of {headers['warc-record-id']} is damaged")
    refers = headers.get("warc-refers-to")
    return {
        "page_id": urn_page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "payload": payload if kind == "response" else None,
        "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": refers and urn_page(refers),
    }


def read_records(archives: DataFrame, places: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records at some places. Ranges of one block of an archive are read together; its bounded size bounds their number."""
    ranges = places.groupBy("archive", "block").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))
    names = [name for name in _RECORDS.names if with_payload or name != "payload"]
    schema = pa.schema([_RECORDS.field(name) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data = memoryview(batch.column("data")[k].as_buffer())
                rows = [_read(data[r["offset"] : r["offset"] + r["length"]]) for r in batch.column("ranges")[k].as_py()]
                yield pa.RecordBatch.from_arrays([pa.array([r[name] for r in rows], schema.field(name).type) for name in names], schema=schema)

    kept = [f for f in RECORDS.split(", ") if f.split(" ")[0] in names]
    return archives.select("archive", "block", "data").join(ranges, ["archive", "block"]).select("data", "ranges").mapInArrow(run, ", ".join(kept))


_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def archive_bytes(archives: DataFrame, archive: int) -> Iterator[bytes]:
    """The bytes of one .warc.gz file, a block at a time; blocks after the current one stay in the store."""
    own = archives.where(F.col("archive") == archive).select("block", "data")
    for (number,) in own.select("block").orderBy("block").toLocalIterator():
        yield bytes(own.where(F.col("block") == number).first()["data"])
