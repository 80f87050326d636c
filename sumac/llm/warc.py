"""WARC archives of a table of pages: a deterministic sharded writer with a manifest, and a reader that checks digests."""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from bisect import bisect_right
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from sumac.llm.texts import as_batch, slices
from sumac.session import freeze

#: Payload bytes of one shard, a range of records that one task writes, and compressed bytes after which it starts another file.
SHARD_BYTES, FILE_BYTES = 32 << 20, 32 << 20
#: Records whose place decides the shards' bounds, per shard.
SAMPLE = 64
#: Repeated payloads are broadcast up to this many (checked by counting); more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: The archives do not depend on when they are written.
DATE = "1970-01-01T00:00:00Z"

MANIFEST = "shard int, file int, temporary string, name string, records long, bytes long, first_page long, last_page long, sha256 string"
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
MANIFEST_SHAPE = pa.schema([(n, _TYPES[t]) for n, t in map(str.split, MANIFEST.split(", "))])
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own, so that a reader may start at any record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _name(page: int, mark: int, copy: int) -> str:
    return f"<urn:x-page:{page}:{mark & (1 << 64) - 1:016x}:{copy}>"


def _page(page: int, mark: int, copy: int, url: str | None, digest: str, size: int, payload: bytes | None, head: tuple[int, int] | None) -> bytes:
    """A response, or a revisit of ``head`` that repeats the HTTP headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = f"urn:x-page:{page}" if url is None else quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")
    headers = [
        ("WARC-Type", "response" if head is None else "revisit"),
        ("WARC-Record-ID", _name(page, mark, copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", digest),
    ]
    if head is None:
        return _record(headers, http + payload)
    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _name(*head, 0))]
    return _record(headers, http)


def _bounds(rows: DataFrame, shard_bytes: int) -> list[tuple[int, int]]:
    """Where shards begin, as (page, mark): chosen from the records of smallest hash, so equal tables get equal shards.

    The driver sees some ``SAMPLE`` pairs of numbers per shard, that is one in ``shard_bytes / SAMPLE`` bytes.
    """
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("size") + 512), F.lit(0))).first()
    shards = -(-size // shard_bytes)
    if shards < 2:
        return []
    share = min(1.0, SAMPLE * shards / n)
    picked = rows.filter(F.pmod(F.xxhash64("page", "mark"), F.lit(1 << 40)) < int(share * (1 << 40)))
    found = sorted(tuple(r) for r in picked.groupBy("page", "mark").agg(F.sum(F.col("size") + 512)).collect())
    total, done, bounds = sum(s for *_, s in found), 0, []
    for page, mark, s in found:
        if done * shards >= total * (len(bounds) + 1):
            bounds.append((page, mark))
        done += s
    return bounds


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    smallest: int = 0,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes every page as a WARC record below ``path``, a new folder all executors reach; returns the manifest.

    Among pages of equal payloads (by SHA-1) of at least ``smallest`` bytes the one with the largest id is the response and the others
    revisit it; of rows that repeat its id the one with the largest hash of (url, payload) counts, and of rows equal in all three one. Smaller payloads are all responses. A null payload is empty, rows without
    an id are left out, a null URL is written as a URN of the page, characters of a URL outside printable ASCII are percent-encoded, other columns are ignored, an empty table makes a manifest without files.

    Records are dealt to shards by ranges of (id, hash), sorted, and written in order; a shard starts another file once ``file_bytes``
    compressed bytes are reached. Names, bounds and bytes follow from the table alone. A task writes under a temporary name of its attempt and reports it;
    the reports of successful attempts are a written table. Files are then renamed, which may be repeated, and the manifest table comes last: a reader
    takes only what it lists, so lost or doubled attempts leave no trace.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.filter("page is not null").withColumns({"size": F.length("payload").cast("long"), "sha1": F.unhex(F.sha1("payload"))})
    rows = rows.withColumn("mark", F.xxhash64("page", "url", "sha1"))
    kinds = rows.filter(F.col("size") >= smallest).groupBy("sha1").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page", "mark")).alias("head"))
    kinds = freeze(kinds.filter("n > 1").select("sha1", "head"), "repeated")
    rows = rows.join(F.broadcast(kinds) if kinds.count() <= BROADCAST_ROWS else kinds, "sha1", "left")
    bounds = _bounds(rows.select("page", "mark", "size"), shard_bytes)

    @F.pandas_udf("int")
    def shard_of(page, mark):
        return page.combine(mark, lambda p, m: bisect_right(bounds, (p, m))).astype("int32")

    own = F.struct("page", "mark") == F.col("head")
    rows = rows.withColumn("payload", F.when(F.col("head").isNull() | own, F.col("payload")))
    dealt = rows.withColumn("shard", shard_of("page", "mark") if bounds else F.lit(0))
    dealt = dealt.repartitionById(len(bounds) + 1, "shard") if bounds else dealt.coalesce(1)
    dealt = dealt.sortWithinPartitions("shard", "page", "mark")

    def run(batches):
        filesystem, base = _filesystem(f"{path}/_temporary")
        filesystem.create_dir(base, recursive=True)
        attempt = uuid.uuid4().hex
        out, shard, number = None, None, 0
        last, copy = None, 0

        def opened():
            temporary = f"{attempt}-{shard}-{number}.warc.gz"
            made = {"temporary": temporary, "stream": filesystem.open_output_stream(f"{base}/{temporary}", compression=None), "sha": hashlib.sha256()}
            made |= {"records": 0, "bytes": 0, "first": None, "last": None}
            info = f"software: sumac\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {shard} file {number}\r\n".encode()
            put(made, _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{shard}:{number}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info))
            return made

        def put(made, data):
            made["stream"].write(data)
            made["sha"].update(data)
            made["bytes"] += len(data)

        def closed(made):
            made["stream"].close()
            values = (shard, number, made["temporary"], f"pages-{shard:06d}-{number:06d}.warc.gz", made["records"], made["bytes"], made["first"], made["last"], made["sha"].hexdigest())
            return pa.RecordBatch.from_pylist([dict(zip(MANIFEST_SHAPE.names, values))], schema=MANIFEST_SHAPE)

        for batch in slices(batches, "payload"):
            for r in batch.to_pylist():
                if r["shard"] != shard or out and out["bytes"] >= file_bytes:
                    if out:
                        yield closed(out)
                    shard, number = r["shard"], number + 1 if r["shard"] == shard else 0
                    out = opened()
                key = (r["page"], r["mark"])
                copy = copy + 1 if key == last else 0
                last = key
                head = r["head"] and (r["head"]["page"], r["head"]["mark"])
                response = head is None or (head == key and not copy)
                digest = "sha1:" + base64.b32encode(r["sha1"]).decode()
                put(out, _page(*key, copy, r["url"], digest, r["size"], r["payload"] if response else None, None if response else head))
                out["records"] += 1
                out["first"], out["last"] = r["page"] if out["first"] is None else out["first"], r["page"]
        if out:
            yield closed(out)

    reported = freeze(dealt.select("shard", "page", "mark", "url", "sha1", "size", "payload", "head").mapInArrow(run, MANIFEST), "reported")

    def rename(batches):
        filesystem, base = _filesystem(path)
        for batch in batches:
            for r in batch.to_pylist():
                source = filesystem.get_file_info(f"{base}/_temporary/{r['temporary']}")
                if source.type == fs.FileType.File:
                    filesystem.move(source.path, f"{base}/{r['name']}")
                if filesystem.get_file_info(f"{base}/{r['name']}").size != r["bytes"]:
                    raise OSError(f"{r['name']} was not committed")
            yield batch

    reported.mapInArrow(rename, MANIFEST).write.parquet(f"{path}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


def _members(stream):
    """The decompressed gzip members of a file, one after the other."""
    left = b""
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            data = left or stream.read(1 << 20)
            if not data:
                if parts:
                    raise ValueError("an archive ends within a record")
                return
            parts.append(unpack.decompress(data))
            left = unpack.unused_data if unpack.eof else b""
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record; a wrong length or block digest raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    block = rest[:size]
    if first != "WARC/1.1" or rest[size:] != b"\r\n\r\n" or _sha1(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    return headers, block


def _number(name: str) -> int:
    return int(name.strip("<>").split(":")[2])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of every page record in the listed files.

    Length and digest are those of the full payload also for a revisit, whose ``payload`` is null. Files are read as streams,
    record by record; a file, block or payload that does not match its digest fails the job.
    """
    columns = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    shape = pa.schema(list(zip(columns, types)))

    def run(batches):
        filesystem, base = _filesystem(path)
        for batch in batches:
            for listed in batch.to_pylist():
                sha, rows, held, records = hashlib.sha256(), [], 0, 0
                with filesystem.open_input_stream(f"{base}/{listed['name']}", compression=None) as stream:
                    for data in _members(_Digesting(stream, sha)):
                        headers, block = parse_record(data)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        records += 1
                        rows.append(_row(headers, block))
                        held += len(block)
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=shape)
                            rows, held = [], 0
                if records != listed["records"] or sha.hexdigest() != listed["sha256"]:
                    raise ValueError(f"{listed['name']} does not match the manifest")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=shape)

    listed = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    files = max(1, listed.count())
    return listed.repartition(min(files, 4096), "name").mapInArrow(run, RECORDS)


class _Digesting(io.RawIOBase):
    """Passes reads on and digests what was read."""

    def __init__(self, stream, sha):
        self.stream, self.sha = stream, sha

    def read(self, size=-1):
        data = self.stream.read(size)
        self.sha.update(data)
        return data


def _row(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, revisit = headers["WARC-Payload-Digest"], headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or _sha1(payload) != digest):
        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    page, target = _number(headers["WARC-Record-ID"]), headers["WARC-Target-URI"]
    url = None if target == f"urn:x-page:{page}" else target
    return page, url, headers["WARC-Type"], _number(headers["WARC-Refers-To"]) if revisit else None, size, digest[5:], None if revisit else payload
