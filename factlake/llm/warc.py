"""WARC archives: a deterministic sharded writer, and a reader.

Writing. Records are range-sorted by page_id and payload digest into shards whose bounds depend on the data alone: on the sizes at
a sample of keys chosen by their hash, of at most ``SAMPLE`` keys. There is a shard for each ``SHARD_BYTES`` of payload, up to
``MOST_SHARDS``, beyond which shards grow. Each shard is a task's stream: a record becomes a gzip member of its
own, with headers and digests regenerated, and a new file begins when the compressed size passes ``file_bytes``, by default
a sixteenth of a shard's payload, so that a shard makes several files. Files get
temporary names with the task's attempt; the rows that Spark commits name the files that count, which are then renamed, also
as a Spark job, and listed in a manifest, written last. A lost task leaves an unlisted file, and a repeated run gives the
same bytes under the same names.

Of records with equal payloads (by SHA-256) of at least ``revisit_bytes``, that with the largest page_id is a response and the
others are revisits, which carry no payload. Only keys and digests are grouped; which records are revisits reaches the
writer as small rows sorted just before the records, so payloads are shuffled once.

Reading. Files, of bounded size, are read whole by Spark; members are parsed one by one, and digests are checked.

A record's id is made of the page_id, the payload's digest and the number of the copy among rows that repeat both, so it is
unique, and the id that a revisit refers to can be told without looking it up.

Defined results: null html is an empty payload; null url gives a urn of the page; rows with null page_id come first and are
revisits only of pages with an id; of rows that repeat page_id and payload the first is the response, and these rows alone are
never split between shards; an empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import written

SHARD_BYTES, MOST_SHARDS, FILES_A_SHARD, REVISIT_BYTES, SAMPLE = 16 << 20, 20_000, 16, 1000, 100_000
#: Compressed bytes that the reader looks at in one step.
PIECE = 16384
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header's value on one line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)  # gzip without a time
    return z.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + z.flush()


def record(page_id: int | None, sha: bytes, copy: int, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    name = f"urn:page:{'' if page_id is None else page_id}"
    digest = sha.hex()
    head = _HTTP.format(len(payload)).encode()
    block = head if revisit else head + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{name}:{digest}:{copy}>"), ("WARC-Date", DATE), ("WARC-Target-URI", _clean(url) if url else name)]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}:{digest}:0>")]
    headers += [("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)), ("Content-Type", "application/http; msgtype=response")]
    return _member(headers, block)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a file, which is walked once, in pieces."""
    view, at = memoryview(data), 0
    while at < len(view):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            piece = view[at : at + PIECE]
            if not len(piece):
                raise ValueError("a record that breaks off")
            parts.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        block = rest[: int(headers["content-length"])]
        if not lines[0].startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
            raise ValueError("a damaged record")
        yield headers, block


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write(path: str, file_bytes: int, revisit_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(path)
        task = TaskContext.get()
        out, shard, number, size, count, digest, done = None, None, 0, 0, 0, None, []
        key, copy, refers = None, 0, None

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((shard, number, f"part-{shard:05d}-{number:05d}.warc.gz", temporary(), size, count, digest.hexdigest()))
                out = None

        def temporary() -> str:
            return f"_temporary/part-{shard:05d}-{number:05d}.{task.taskAttemptId()}"

        def put(data: bytes, n: int = 1) -> None:
            nonlocal size, count
            out.write(data)
            digest.update(data)
            size, count = size + len(data), count + n

        for batch in batches:
            for s, page, url, payload, sha, to in zip(*[batch.column(c).to_pylist() for c in ("shard", "page_id", "url", "payload", "sha", "refers_to")], strict=True):
                if s != shard:
                    close()
                    shard, number = s, 0
                if key != (page, sha):
                    key, copy, refers = (page, sha), 0, None
                if payload is None:  # says that the next records are revisits
                    refers = to
                    continue
                if out is not None and size >= file_bytes:
                    close()
                    number += 1
                if out is None:
                    size, count, digest = 0, 0, hashlib.sha256()
                    out = files.open_output_stream(f"{root}/{temporary()}", compression=None)
                    info = f"software: factlake\r\nformat: WARC File Format 1.1\r\npart: {shard} {number}\r\n".encode()
                    put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:part:{shard}:{number}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info), 0)
                again = refers is None and copy > 0 and len(payload) >= revisit_bytes and page is not None
                put(record(page, sha, copy, url, payload, page if again else refers, again or refers is not None))
                copy += 1
        close()
        if done:
            names = ["shard", "number", "file", "temporary", "bytes", "records", "sha256"]
            types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

    return run


def _rename(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = _files(path)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(), batch.column("file").to_pylist(), strict=True):
                if files.get_file_info(f"{root}/{old}").type != fs.FileType.NotFound:  # else an earlier attempt has renamed it
                    files.move(f"{root}/{old}", f"{root}/{new}")
            yield batch.select(["shard", "number", "file", "bytes", "records", "sha256"])

    return run


_LEAST = -(1 << 63)  # stands for a null page_id


def _bounds(keys: DataFrame, shards: int, rows: int) -> list[tuple[int, int]]:
    """Keys (page_id, first eight bytes of the digest) at which shards begin, from the sizes at a sample of keys that their
    hashes choose."""
    if shards < 2:
        return []
    every = max(1, -(-rows // (SAMPLE // 2)))
    key = [F.coalesce("page_id", F.lit(_LEAST)).alias("page_id"), _lead("sha").alias("lead")]
    sample = keys.select(*key, "size").filter(F.pmod(F.xxhash64("page_id", "lead"), F.lit(every)) == 0).groupBy("page_id", "lead").agg(F.sum("size").alias("size")).collect()  # half of SAMPLE or so
    if not sample:
        return []
    found = sorted((r.page_id, r.lead, r.size) for r in sample)
    upto = np.cumsum(np.array([size for _, _, size in found], np.int64) + 512)
    cuts = np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards)
    return sorted({found[i][:2] for i in cuts.tolist()})


def _lead(sha: str) -> Column:
    """The first bytes of a digest as an integer that sorts as they do."""
    return F.conv(F.hex(F.substring(F.col(sha), 1, 7)), 16, 10).cast("long")


def _placed(bounds: list[tuple[int, int]]):
    """The shard of each row: the number of bounds that are not above its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = np.array([p for p, _ in bounds], np.int64)
        for batch in batches:
            page = batch.column("page_id").fill_null(_LEAST).to_numpy(zero_copy_only=False)
            shard, upto = (np.searchsorted(pages, page, side=s) for s in ("left", "right"))
            for i in np.flatnonzero(shard < upto).tolist():  # pages at which a bound lies
                shard[i] = bisect_right(bounds, (int(page[i]), int.from_bytes(batch.column("sha")[i].as_py()[:7], "big")))
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *batch.columns], names=["shard", *batch.schema.names])

    return run


def write(df: DataFrame, path: str, file_bytes: int | None = None, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Writes a record for each row of ``df`` (page_id, url, html) under ``path`` (a folder that all executors see) and returns
    the manifest: shard, number, file, bytes, records, sha256."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = df.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keys = pages.select("page_id", F.unhex(F.sha2("payload", 256)).alias("sha"), F.octet_length("payload").cast("long").alias("size"))
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = int(min(MOST_SHARDS, 1 + total // SHARD_BYTES))
    file_bytes = file_bytes or max(SHARD_BYTES, total // shards) // FILES_A_SHARD
    long = keys.filter(F.col("size") >= revisit_bytes)
    copies = long.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 and refers_to is not null").drop("n")
    copies = written(copies, "repeated-payloads")  # a table of its own, so that Spark can split a frequent payload's rows in the join
    revisits = long.join(copies, "sha").filter("page_id is null or page_id <> refers_to").select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "sha", "refers_to", F.lit(0).alias("k")).distinct()
    both = pages.select("page_id", "url", "payload", F.unhex(F.sha2("payload", 256)).alias("sha"), F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("k")).unionByName(revisits)
    placed = both.mapInArrow(_placed(_bounds(keys, shards, rows)), "shard int, page_id long, url string, payload binary, sha binary, refers_to long, k int")
    sorted_ = placed.repartitionById(shards, "shard").sortWithinPartitions("shard", "page_id", "sha", "k", "url")
    files, root = _files(path)
    files.create_dir(f"{root}/_temporary", recursive=True)
    schema = "shard int, number int, file string, temporary string, bytes long, records long, sha256 string"
    sorted_.mapInArrow(_write(path, file_bytes, revisit_bytes), schema).write.parquet(f"{path}/_written")
    done = df.sparkSession.read.schema(schema).parquet(f"{path}/_written")
    final = "shard int, number int, file string, bytes long, records long, sha256 string"
    done.mapInArrow(_rename(path), final).write.json(f"{path}/manifest")
    files.delete_dir(f"{root}/_temporary")  # what is left there is of attempts that don't count
    return df.sparkSession.read.schema(final).json(f"{path}/manifest")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def page(uri: str) -> int | None:
        part = uri.strip("<>").split(":")[2]
        return int(part) if part else None

    for batch in batches:
        for data in batch.column("content"):
            rows, held = [], 0
            for headers, block in records(data.as_buffer()):
                if headers["warc-type"] == "warcinfo":
                    continue
                head, _, payload = block.partition(b"\r\n\r\n")
                revisit = headers["warc-type"] == "revisit"
                if _sha1(block) != headers["warc-block-digest"] or not revisit and _sha1(payload) != headers["warc-payload-digest"]:
                    raise ValueError(f"a wrong digest in {headers['warc-record-id']}")
                size = int(head.rpartition(b"Content-Length: ")[2])
                digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                refers = page(headers["warc-refers-to"]) if revisit else None
                rows.append((page(headers["warc-record-id"]), headers["warc-target-uri"], None if revisit else payload, size, digest, headers["warc-type"], refers))
                held += len(payload)
                if held > 8 << 20:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives under ``path``: page_id, url, payload (null for revisits), payload_bytes,
    payload_digest (hex SHA-1, of the full payload), record_type, refers_to."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("content")
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.mapInArrow(_parse, schema)
