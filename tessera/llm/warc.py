"""WARC archives: a deterministic sharded writer, and a reader that checks what it reads.

Which record of equal payloads is the response, and which shard a record falls into, is decided on narrow rows (id, hashes, size): records
are range-sorted by id, and a running total of their sizes cuts the order into shards. So shards depend on the table
alone, not on sampling or partitions. Payloads then travel once, to the shard of their response. A task writes its
shards in order, rolls files by compressed size, and builds each header and digest anew from the payload.

Commit. A file is written under a temporary name and renamed when it is whole. What counts as written is the manifest, a Parquet
table (file, records, bytes, sha256) that Spark commits at the end of the job; files of lost or repeated attempts
either have the same name and bytes or are not listed. The reader takes listed files only and checks their digests.

A revisit keeps the HTTP header of its payload, so size and digest can be read without the payload. Ids are kept in the extension fields
``X-Page-Id`` and ``X-Refers-To-Page-Id``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, running_total

SHARD_BYTES = 64 << 20  # payload bytes of a shard, more if that made over MAX_SHARDS
MAX_SHARDS = 1 << 16
ROLL_BYTES = 32 << 20  # compressed bytes at which a file ends
HEADER_BYTES = 600  # estimated bytes of a record's headers
COPIES = 1 << 12  # equal rows in one narrow row
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "manifest"
_MANIFEST_TYPE = "file string, records long, bytes long, sha256 string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, k: int, sha: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{k}|{sha}|{copy}')}>"


def _url(url: str) -> str:
    """A header value: control characters are percent-encoded."""
    return url if url.isprintable() else "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))] if value is not None)
    return b"".join((b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"))


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


class _Roll:
    """Files of one shard, each written under a temporary name and renamed when whole."""

    def __init__(self, target: str, shard: int, roll_bytes: int, level: int, date: str):
        self.fs, self.root = pafs.FileSystem.from_uri(target)
        self.shard, self.roll_bytes, self.level, self.date = shard, roll_bytes, level, date
        self.number, self.out, self.done = 0, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()
            self._put(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"),
                               ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")],
                              b"format: WARC File Format 1.1\r\n"))
        self._put(record)
        self.records += 1
        if self.bytes >= self.roll_bytes:
            self.close()

    def _put(self, record: bytes) -> None:
        zipped = zlib.compressobj(self.level, zlib.DEFLATED, 31)  # one gzip member a record
        for part in (zipped.compress(record), zipped.flush()):
            self.out.write(part)
            self.digest.update(part)
            self.bytes += len(part)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.root}/{self.name}")
            self.done.append((self.name, self.records, self.bytes, self.digest.hexdigest()))
            self.number, self.out = self.number + 1, None


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    body = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    return rows.withColumn("sha", F.sha2("body", 256)).withColumn("k", F.xxhash64("url", "sha"))


def records(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Narrow rows, one per up to ``COPIES`` equal rows: page_id, url, k, sha, n (payload bytes), sha1, block, copies, body (payloads
    under ``least_bytes`` only), opens (its first copy is a response), refers_id and refers_k (of the response)."""
    keyed = _keyed(pages, id_col, url_col, html_col)
    narrow = keyed.select("page_id", "url", "k", "sha", F.octet_length("body").cast("long").alias("n"), F.sha1("body").alias("sha1"),
                          F.when(F.octet_length("body") < least_bytes, F.col("body")).alias("body"))
    narrow = cut(narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("m")))
    # the response of equal payloads: the smallest id (null ids come last), one row a payload
    first = (narrow.where(F.col("n") >= least_bytes).groupBy("sha").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "k")).alias("f"), F.sum("m").alias("all"))
             .where(F.col("all") > 1).select("sha", F.col("f.page_id").alias("refers_id"), F.col("f.k").alias("refers_k")))
    known = narrow.join(first, "sha", "left").withColumn("opens", F.expr("refers_k is null or (k = refers_k and page_id <=> refers_id)"))
    blocks = known.withColumn("block", F.explode(F.expr(f"sequence(0L, (m - 1) div {COPIES})")))
    blocks = blocks.withColumn("copies", F.least(F.lit(COPIES), F.col("m") - F.col("block") * COPIES).cast("long"))
    # small payloads and payloads that occur once have no revisits
    return blocks.withColumn("opens", F.expr("opens and (block = 0 or body is not null)")).drop("m")


def _lines(rows: Iterator[tuple]) -> Iterator[tuple[int, bytes]]:
    """(shard, record) from the sorted stream of narrow rows, each response's followed by its payload."""
    def fields(kind, page_id, url, k, sha, copy, digest, block, date):
        return [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id, k, sha, copy)), ("WARC-Date", date),
                ("WARC-Target-URI", None if url is None else _url(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
                ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("X-Page-Id", None if page_id is None else str(page_id)),
                ("Content-Type", "application/http; msgtype=response")]

    def response(r, copy, body, date):
        block = _http(len(body)) + body
        return _record(fields("response", r["page_id"], r["url"], r["k"], r["sha"], copy, base32_sha1(body), block, date), block)

    def revisits(r, begin, date):
        block, digest = _http(r["n"]), base64.b32encode(bytes.fromhex(r["sha1"])).decode()
        refers = _record_id(r["refers_id"], r["refers_k"], r["sha"], 0)
        more = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", refers),
                ("X-Refers-To-Page-Id", None if r["refers_id"] is None else str(r["refers_id"]))]
        for copy in range(begin, r["copies"]):
            own = fields("revisit", r["page_id"], r["url"], r["k"], r["sha"], r["block"] * COPIES + copy, digest, block, date)
            yield r["shard"], _record(own + more, block)

    waiting = None
    for r, date in rows:
        if r["kind"] == 1:
            key = (r["shard"], r["page_id"], r["k"], r["sha"])
            if waiting and key == (waiting["shard"], waiting["page_id"], waiting["k"], waiting["sha"]):
                yield r["shard"], response(waiting, 0, r["body"].encode(), date)
                yield from revisits(waiting, 1, date)
                waiting = None
            continue
        if waiting:
            raise RuntimeError(f"no payload for page {waiting['page_id']}")
        if r["opens"] and r["body"] is not None:
            for copy in range(r["copies"]):
                yield r["shard"], response(r, r["block"] * COPIES + copy, r["body"].encode(), date)
        elif r["opens"]:
            waiting = r
        else:
            yield from revisits(r, 0, date)
    if waiting:
        raise RuntimeError(f"no payload for page {waiting['page_id']}")


def write(pages: DataFrame, target: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, level: int = 6, date: str = DATE) -> None:
    """Write one WARC record per row of ``pages`` to ``target``, a shared folder (a path or a URI that pyarrow knows).

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of at least ``least_bytes`` bytes, that with the
    smallest id is the response, the others revisit it; of rows that share this id too, the one with the smallest hash of url. A null id comes
    after all others in this choice and has no id field; a null url has no target field. Repeated rows are records of their own; they are
    counted and travel as blocks of ``COPIES``, so a hot row spreads over shards. A very long payload is one record and one row.
    An empty table writes an empty manifest. Other columns are ignored whatever their names.
    """
    rows = records(pages, least_bytes, id_col, url_col, html_col)
    rows = rows.withColumn("_w", F.when(F.col("opens"), F.col("n")).otherwise(0) + F.col("copies") * HEADER_BYTES)
    order = ["page_id", "k", "sha", "block"]
    placed = cut(running_total(rows, [F.col(c) for c in order], "_w", "_at"))
    whole = placed.agg(F.max(F.col("_at") + F.col("_w"))).first()[0] or 0
    per_shard = max(shard_bytes, -(-whole // MAX_SHARDS))
    placed = placed.withColumn("shard", F.expr(f"_at div {per_shard}L")).drop("_at", "_w")
    firsts = placed.groupBy("shard").agg(F.min(F.struct(F.col("page_id").isNotNull().alias("has"), *order)).alias("f")).orderBy("shard").collect()
    shards = [r["shard"] for r in firsts]  # at most MAX_SHARDS
    borders = [(r["f"]["has"], r["f"]["page_id"] or 0, r["f"]["k"], r["f"]["sha"], r["f"]["block"]) for r in firsts]

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, kept, seen = [], [], set()
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "k", "sha")))):
                if key not in seen:
                    seen.add(key)
                    kept.append(i)
                    own.append(shards[max(0, bisect_right(borders, (key[0] is not None, key[0] or 0, *key[1:], 0)) - 1)])
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(kept, pa.int64())).columns, pa.array(own, pa.int64())], names=[*batch.schema.names, "shard"])

    body = _keyed(pages, id_col, url_col, html_col).select("page_id", "k", "sha", "body").where(F.octet_length("body") >= least_bytes)
    bodies = body.mapInArrow(to_shards, "page_id long, k long, sha string, body string, shard long")
    both = placed.withColumn("kind", F.lit(0)).unionByName(bodies.withColumns({"kind": F.lit(1), "block": F.lit(0).cast("long")}), allowMissingColumns=True)
    dealt = both.repartition(max(1, len(shards)), "shard").sortWithinPartitions("shard", *order, "kind")
    filesystem, root = pafs.FileSystem.from_uri(target)
    filesystem.create_dir(f"{root}/_temporary", recursive=True)

    def write_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = ((r, date) for batch in batches for small in _small(batch) for r in small.to_pylist())
        files = None
        for shard, record in _lines(stream):
            if files is None or files.shard != shard:
                if files is not None:
                    files.close()
                    yield _listed(files.done)
                files = _Roll(target, shard, roll_bytes, level, date)
            files.add(record)
        if files is not None:
            files.close()
            yield _listed(files.done)

    dealt.mapInArrow(write_shards, _MANIFEST_TYPE).write.parquet(f"{target}/{MANIFEST}")


def _small(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def _listed(done: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names=["file", "records", "bytes", "sha256"])


def members(stream, digest=None) -> Iterator[bytes]:
    """Decompressed gzip members of a binary stream, one at a time."""
    zipped, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        if digest is not None:
            digest.update(chunk)
        while chunk:
            parts.append(zipped.decompress(chunk))
            if not zipped.eof:
                break
            yield b"".join(parts)
            chunk = zipped.unused_data
            zipped, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; the block's length and digest are checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"not a whole WARC record: {fields.get('WARC-Record-ID')}")
    if fields.get("WARC-Block-Digest", x := f"sha1:{base32_sha1(block)}") != x:
        raise ValueError(f"wrong block digest in {fields['WARC-Record-ID']}")
    return fields, block


def read(spark: SparkSession, target: str, payload: bool = True) -> DataFrame:
    """Responses and revisits of the listed files: page_id, url, record_id, record_type, payload_bytes, payload_digest, refers_to (page id),
    refers_to_record, file, and html (null for revisits), unless ``payload`` is false. Wrong or missing bytes raise."""
    listed = spark.read.schema(_MANIFEST_TYPE).parquet(f"{target}/{MANIFEST}")
    schema = ("page_id long, url string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
              "refers_to_record string, file string" + ", html string" * payload)
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64() if " long" in x else pa.string() for x in schema.split(", ")]

    def row(fields: dict[str, str], block: bytes, file: str) -> tuple:
        head, _, body = block.partition(b"\r\n\r\n")
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(next(x for x in head.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
        if kind == "response" and (len(body) != size or base32_sha1(body) != digest):
            raise ValueError(f"wrong payload in {fields['WARC-Record-ID']}")
        number = lambda x: None if x not in fields else int(fields[x])
        found = (number("X-Page-Id"), fields.get("WARC-Target-URI"), fields["WARC-Record-ID"], kind, size, digest, number("X-Refers-To-Page-Id"),
                 fields.get("WARC-Refers-To"), file)
        return (*found, body.decode() if kind == "response" else None) if payload else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(target)
        for batch in batches:
            for listed in batch.to_pylist():
                rows, held, digest, count = [], 0, hashlib.sha256(), 0
                with filesystem.open_input_stream(f"{root}/{listed['file']}", compression=None) as stream:
                    for record in members(stream, digest):
                        fields, block = parse(record)
                        if fields["WARC-Type"] not in ("response", "revisit"):
                            continue
                        rows.append(row(fields, block, listed["file"]))
                        held, count = held + len(block) + 500, count + 1
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows, held = [], 0
                if count != listed["records"] or digest.hexdigest() != listed["sha256"]:
                    raise ValueError(f"{listed['file']} is not the file that the manifest lists")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    files = listed.count()
    return listed.repartition(max(1, files)).mapInArrow(run, schema)
