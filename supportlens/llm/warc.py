"""WARC archives of pages, written and read by Spark.

Writing: a narrow table of page ids and payload digests says which record revisits which, and gives the bounds of the shards: the
keys with the least hashes are a sample of at most SAMPLE keys, the same in every run, weighted by bytes. Pages and the narrow
rows of revisits go to their shard together, in one shuffle, and are sorted there, so that each page meets its revisit row
without a join. A task streams its shard's records into files, one gzip member a record, and starts the next file once one holds FILE_BYTES of
compressed data. Headers, identifiers and digests are made from the row alone and no clock is read: the same pages give the same files,
byte by byte, however the table is cut into tasks.

Committing: a task writes under names of its own attempt in `_temporary` and returns a manifest row a file. Only the rows of the
attempts that Spark takes are stored; a second job renames their files and stores the manifest. Readers know files by the
manifest alone, so that what a lost attempt has left behind counts for nothing.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens.llm.common import new_path, stored

#: Payloads of so many bytes and more are written once; equal ones revisit that record.
LEAST_BYTES = 1000
#: Payload bytes of a shard, most shards, and keys of which their bounds are taken.
SHARD_BYTES, MAX_SHARDS, SAMPLE = 16 << 20, 4096, 65_536
#: Compressed bytes after which a file is full.
FILE_BYTES = 1 << 30
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes read at once, and records or bytes of payload sent on at once.
CHUNK, BATCH, BATCH_BYTES = 1 << 20, 1000, 8 << 20

_FILES = "name string, shard int, records bigint, payload_bytes bigint, size bigint, sha1 string"


def _order(id_: Column, kind: str) -> Column:
    """A text that sorts like the ids, null first."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        text = F.lpad((id_.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
    else:
        text = id_.cast("string")
    return F.when(id_.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


def _rows(pages: DataFrame, id_col: str, url_col: str, text_col: str) -> DataFrame:
    """page_id, url, payload, digest (hex) and key (order of id and digest) of every page."""
    payload = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    return rows.withColumn("key", F.concat(_order(F.col("page_id"), rows.schema["page_id"].dataType.simpleString()), F.lit(" "), F.col("digest")))


def revisits(pairs: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, digest, key, refers_to: one row for each id and payload (`pairs`: also bytes) that isn't the one its payload is written
    for, the largest id."""
    last = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id")).alias("last")
    long = pairs.filter(F.col("bytes") >= least_bytes)
    groups = stored(long.groupBy("digest").agg(last, F.count(F.lit(1)).alias("ids")).filter("ids > 1").select("digest", "last.page_id"), "warc-groups")
    met = long.select("page_id", "digest", "key").join(groups.withColumnRenamed("page_id", "refers_to"), "digest")
    return met.filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "key", "refers_to")


def bounds(pairs: DataFrame, shards: int) -> list[str]:
    """At most shards - 1 rising keys that cut the payload bytes into near equal parts."""
    weight = (F.col("bytes") * F.col("n") + 1).alias("weight")
    sample = pairs.select("key", weight).orderBy(F.xxhash64("key"), "key").limit(SAMPLE).collect() if shards > 1 else []
    sample.sort()
    total, passed, cuts = sum(row.weight for row in sample), 0, []
    for row in sample:
        if passed * shards >= (len(cuts) + 1) * total and (not cuts or row.key > cuts[-1]):
            cuts.append(row.key)
        passed += row.weight
    return cuts[: shards - 1]


def with_shard(rows: DataFrame, cuts: list[str]) -> DataFrame:
    """`rows` with the int column shard: the number of `cuts` up to the column key, looked up by blocks of about the root of their number."""
    if not cuts:
        return rows.withColumn("shard", F.lit(0))
    width = math.isqrt(len(cuts) - 1) + 1
    told = lambda texts: "array(" + ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in texts) + ")"
    blocks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    block = F.expr(f"size(filter({told([b[0] for b in blocks])}, b -> b <= key))")
    within = F.expr(f"size(filter(element_at(array({', '.join(map(told, blocks))}), _block), b -> b <= key))")
    shard = F.when(F.col("_block") == 0, 0).otherwise((F.col("_block") - 1) * width + within)
    return rows.withColumn("_block", block).withColumn("shard", shard.cast("int")).drop("_block")


def _sha1(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page: str | None, digest: str, copy: int) -> str:
    """A record's identifier, made from its page, payload digest and place among equal rows."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{digest}:{copy}')}>"


def _headed(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def info_record(name: str, date: str = DATE) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    headers = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("file", name, 0)), ("WARC-Date", date), ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", _sha1(hashlib.sha1(block).digest())),
    ]
    return _headed(headers, block)


def page_record(page: str | None, url: str | None, payload: bytes, digest: str, copy: int = 0, refers: tuple[str | None] | None = None, date: str = DATE) -> bytes:
    """A response record, or with `refers` (the page referred to) a revisit without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    headers = [
        ("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", record_id(page, digest, copy)), ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~")), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _sha1(bytes.fromhex(digest))), ("WARC-Block-Digest", _sha1(hashlib.sha1(block).digest())),
    ]
    if page is not None:
        headers.append(("WARC-Page-ID", quote(page)))
    if refers:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers[0], digest, 0))]
        if refers[0] is not None:
            headers.append(("WARC-Refers-To-Page-ID", quote(refers[0])))
    return _headed(headers, block)


class _Files:
    """The files of one task's shard, one after the other."""

    def __init__(self, folder: str, attempt: int, file_bytes: int, date: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.attempt, self.file_bytes, self.date = attempt, file_bytes, date
        self.fs.create_dir(f"{self.folder}/_temporary", recursive=True)
        self.out, self.shard, self.number, self.done = None, None, 0, []

    def _member(self, data: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(data) + packer.flush()
        self.out.write(packed)
        self.sha1.update(packed)
        self.size += len(packed)

    def write(self, shard: int, record: bytes, payload_bytes: int) -> None:
        if shard != self.shard or self.out and self.size >= self.file_bytes:
            self.number = self.number + 1 if shard == self.shard else 0
            self.close()
            self.shard = shard
            self.name = f"pages-{shard:05d}-{self.number:05d}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.folder}/_temporary/{self.name}.{self.attempt}", compression=None)
            self.size, self.records, self.payload, self.sha1 = 0, 0, 0, hashlib.sha1()
            self._member(info_record(self.name, self.date))
        self._member(record)
        self.records += 1
        self.payload += payload_bytes

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.done.append((self.name, self.shard, self.records, self.payload, self.size, self.sha1.hexdigest(), self.attempt))
            self.out = None


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least_bytes: int = LEAST_BYTES,
    shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE,
) -> DataFrame:
    """Writes a record a page to `path`, a folder that doesn't exist yet, in order of id (null first) and digest, and returns the manifest: name,
    shard, records, payload_bytes, size and sha1 of each file.

    Null payloads are empty ones. Equal payloads below `least_bytes` are all written. Rows of one id and payload are a response (if theirs is
    the largest id) and revisits of it; they stay together in one task, as narrow records. Null urls become about:blank. An
    empty table gives no files and an empty manifest. Other columns are ignored.
    """
    spark = pages.sparkSession
    rows = _rows(pages, id_col, url_col, text_col)
    counted = rows.groupBy("page_id", "digest", "key").agg(F.count(F.lit(1)).alias("n"), F.first(F.octet_length("payload")).cast("bigint").alias("bytes"))
    pairs = stored(counted, "warc-pairs")
    total = pairs.agg(F.sum(F.col("bytes") * F.col("n"))).first()[0] or 0
    shards = max(1, min(MAX_SHARDS, math.ceil(total / shard_bytes)))
    cuts = bounds(pairs, shards)
    told = revisits(pairs, least_bytes).select(
        "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("page"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("payload"), "digest", F.col("refers_to").cast("string").alias("refers"),
    )
    known = rows.select("key", F.lit(1).alias("kind"), F.col("page_id").cast("string").alias("page"), "url", "payload", "digest", F.lit(None).cast("string").alias("refers"))
    dealt = with_shard(told.union(known), cuts).repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", "key", "kind", "url")
    dealt = dealt.select("shard", "key", "kind", "page", "url", "payload", "digest", "refers")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(path, TaskContext.get().taskAttemptId(), file_bytes, date)
        now, copies, refers = None, 0, None
        for batch in batches:
            for shard, key, kind, page, url, payload, digest, to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    now, copies, refers = key, 0, None
                if kind == 0:
                    refers = (to,)
                    continue
                own = refers or ((page,) if copies else None)
                record = page_record(page, url, payload, digest, copies, own if len(payload) >= least_bytes else None, date)
                files.write(shard, record, len(payload))
                copies += 1
        files.close()
        yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in files.done], schema=schema)

    names = [field.split()[0] for field in _FILES.split(", ")] + ["attempt"]
    types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    schema = pa.schema([(field.split()[0], types[field.split()[1]]) for field in f"{_FILES}, attempt bigint".split(", ")])
    taken = f"{path}/_temporary/manifest"
    dealt.mapInArrow(write, f"{_FILES}, attempt bigint").write.parquet(taken)
    return _commit(spark, path, taken)


def _commit(spark: SparkSession, path: str, taken: str) -> DataFrame:
    """Renames the files of the rows in `taken` and stores the manifest. A file that an earlier attempt has renamed is left as it is."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{folder}/_temporary/{row['name']}.{row['attempt']}", f"{folder}/{row['name']}"
                try:
                    fs.move(old, new)
                except OSError:
                    if fs.get_file_info(new).size != row["size"]:
                        raise
            yield batch

    files = spark.read.schema(f"{_FILES}, attempt bigint").parquet(taken)
    files = files.repartition(max(1, min(files.count(), MAX_SHARDS))).mapInArrow(rename, files.schema)
    files.drop("attempt").coalesce(max(1, math.isqrt(files.rdd.getNumPartitions()))).write.parquet(f"{path}/_manifest")
    temporary = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_temporary")
    temporary.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(temporary, True)
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of an archive that was written whole."""
    return spark.read.schema(_FILES).parquet(f"{path}/_manifest")


def members(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member of a file, one at a time."""
    rest, at = b"", 0
    while True:
        data = rest or stream.read(CHUNK)
        if not data:
            return
        opener, parts, used = zlib.decompressobj(31), [], 0
        while True:
            parts.append(opener.decompress(data))
            used += len(data) - len(opener.unused_data)
            if opener.eof:
                break
            data = stream.read(CHUNK)
            if not data:
                raise ValueError("a record is cut off")
        yield at, b"".join(parts)
        rest, at = opener.unused_data, at + used


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record. Raises ValueError if its length or digest is wrong."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or headers["warc-block-digest"] != _sha1(hashlib.sha1(block).digest()):
        raise ValueError("a record is damaged")
    return headers, block


def page_of(headers: dict[str, str], block: bytes) -> dict:
    """The row of a response or revisit. Raises ValueError if a payload doesn't have its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
    response = headers["warc-type"] == "response"
    if response and (len(payload) != length or hashlib.sha1(payload).digest() != digest):
        raise ValueError("a payload is damaged")
    ids = (headers.get(f"warc-{name}page-id") for name in ("", "refers-to-"))
    page, refers = (None if i is None else unquote(i) for i in ids)
    return {
        "page_id": page, "url": headers["warc-target-uri"], "payload_bytes": length, "payload_digest": digest.hex(), "record_type": headers["warc-type"],
        "refers_to": refers, "record_id": headers["warc-record-id"], "payload": payload if response else None,
    }


def read_archives(spark: SparkSession, path: str, kind: str = "bigint", payloads: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest (hex), record_type, refers_to (ids of the type `kind`), record_id, file and offset of each page
    record; with `payloads` the payload too (null for revisits). Each file is held against its manifest row, each record against its
    digests. A task reads files record by record."""
    fields = [("page_id", "string"), ("url", "string"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "string"), ("record_id", "string")]
    fields += [("payload", "binary")] * payloads + [("file", "string"), ("offset", "bigint")]
    types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, types[kind]) for name, kind in fields])
    files = manifest(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for file in batch.to_pylist():
                rows, held, sha1 = [], 0, hashlib.sha1()
                with fs.open_input_stream(f"{folder}/{file['name']}", compression=None) as stream:
                    for at, record in members(_Summed(stream, sha1)):
                        headers, block = parsed(record)
                        if headers["warc-type"] not in ("response", "revisit"):
                            continue
                        row = page_of(headers, block) | {"file": file["name"], "offset": at}
                        rows.append(row)
                        held += len(row["payload"] or b"") if payloads else 0
                        if len(rows) >= BATCH or held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if sha1.hexdigest() != file["sha1"]:
                    raise ValueError(f"{file['name']} isn't the file of the manifest")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = files.repartition(max(1, min(files.count(), MAX_SHARDS)))
    rows = files.mapInArrow(read, ", ".join(f"{name} {kind}" for name, kind in fields))
    return rows.withColumns({name: F.col(name).cast(kind) for name in ("page_id", "refers_to")})


class _Summed:
    """A stream that adds what is read to a checksum."""

    def __init__(self, stream, sha1):
        self.stream, self.sha1 = stream, sha1

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.sha1.update(data)
        return data


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Writes the pages to new archives in the shared folder and reads them back: id_col, payload_bytes, payload_digest, record_type and
    refers_to of each row. Odd rows as in `write_archives`."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, **options)
    rows = read_archives(pages.sparkSession, path, pages.schema[id_col].dataType.simpleString())
    return rows.select(F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
