"""A deterministic, sharded WARC writer, and a reader.

Records are range-sorted by id. The ranges come from exact byte sums (``id_ranges``), one task writes a
range, and a range's file rolls to the next when its compressed size passes ``roll_bytes``. Headers, record ids and
digests are made anew from the rows, with one date for the whole run, so that a second run writes the same bytes. A file
is written under a temporary name and renamed when complete; the manifest, written last, lists the files that count, and a
reader opens no others. A lost task writes the same files again.

Payloads that occur more than once are stored once: the record with the least id is the response, the others are
revisit records which name it. Which payloads repeat is found from their digests alone; what a range must know about its
revisits reaches its task as marker rows, sorted in before the pages, so that each page is shuffled once.

A url goes into its header with control characters, spaces and ``%`` as percent escapes, and is read back as it was.

Defined cases: a null payload is empty; a null url is the empty string; a null id sorts first (it is a revisit where another
row has its payload, and two null ids with one payload are response and revisit); of rows that agree in id and payload
the first is the response and the others revisit it; an empty table gives an empty manifest; columns other than those named are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm.common import id_ranges, materialize, new_path, range_of, table
from skyquilt.llm.files import read_stream, whole_file

#: About what a record has besides its payload, for the sizes of ranges.
HEAD_BYTES = 700
MANIFEST_SCHEMA = "shard int, file string, records bigint, bytes bigint, sha256 string"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122: URLs


#: What can't stand in a header as it is: control characters (line ends among them), spaces, the escape itself.
UNSAFE = re.compile("[\x00-\x20\x7f-\x9f\u2028\u2029%]")


def escape_url(url: str) -> str:
    return UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url)


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(page_id: int | None, copy: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{copy}/{digest}')}>"


def record_bytes(kind: str, rid: str, date: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {date}"]
    lines += [f"{k}: {v}" for k, v in headers] + [f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class _Roller:
    """Writes the records of one shard, each a gzip member, to files of about ``roll_bytes``."""

    def __init__(self, root: str, shard: int, date: str, roll_bytes: int):
        self.root, self.shard, self.date, self.roll_bytes = root, shard, date, roll_bytes
        self.done: list[tuple] = []
        self.open = None

    def add(self, raw: bytes) -> None:
        member = gzip.compress(raw, compresslevel=5, mtime=0)
        if self.open and self.n_bytes and self.n_bytes + len(member) > self.roll_bytes and self.n_records:
            self.close()
        if not self.open:
            self.name = f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.context = whole_file(f"{self.root}/{self.name}")
            self.open, self.n_bytes, self.n_records, self.sha = self.context.__enter__(), 0, 0, hashlib.sha256()
            info = f"software: skyquilt\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
            head = record_bytes("warcinfo", record_id(None, 0, self.name), self.date, [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info)
            self._put(gzip.compress(head, compresslevel=5, mtime=0))
        self._put(member)
        self.n_records += 1

    def _put(self, member: bytes) -> None:
        self.open.write(member)
        self.sha.update(member)
        self.n_bytes += len(member)

    def close(self) -> None:
        if self.open:
            self.context.__exit__(None, None, None)
            self.done.append((self.shard, self.name, self.n_records, self.n_bytes, self.sha.hexdigest()))
            self.open = None

    def abandon(self, error: BaseException) -> None:
        if self.open:
            try:
                self.context.__exit__(type(error), error, error.__traceback__)
            except type(error):
                pass
            self.open = None


def _page(row, responder, copy: int, first, date: str) -> bytes:
    """The record of one page. ``first``: whether it is the response of its payload."""
    html = bytes(row.payload)
    digest = base32_sha1(html)
    me = None if row.id is None else int(row.id)
    headers = [("WARC-Target-URI", escape_url(row.url)), ("WARC-Payload-Digest", f"sha1:{digest}")]
    headers += [("X-Page-Id", str(me))] if me is not None else []
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    if first:
        return record_bytes("response", record_id(me, copy, digest), date, [*headers, ("Content-Type", "application/http; msgtype=response")], http + html)
    headers += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", record_id(responder, 0, digest)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    headers += [("X-Refers-To-Page-Id", str(responder))] if responder is not None else []
    return record_bytes("revisit", record_id(me, copy, digest), date, headers, http)


def _writer(root: str, date: str, roll_bytes: int, min_bytes: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roller, marker, last, copy = None, None, None, 0
        try:
            for pdf in batches:
                for row in pdf.itertuples(index=False):
                    if roller is None or roller.shard != row.shard:
                        if roller:
                            roller.close()
                            yield pd.DataFrame(roller.done, columns=["shard", "file", "records", "bytes", "sha256"])
                        roller = _Roller(root, int(row.shard), date, roll_bytes)
                    here = (None if row.id is None else int(row.id), row.digest)
                    if row.kind == 0:
                        marker = (here, None if row.responder is None else int(row.responder))
                        continue
                    copy = copy + 1 if here == last else 0
                    last = here
                    if marker and marker[0] == here:
                        first, responder = False, marker[1]
                    else:
                        first, responder = copy == 0 or len(row.payload) < min_bytes, here[0]
                    roller.add(_page(row, responder, copy, first, date))
            if roller:
                roller.close()
                yield pd.DataFrame(roller.done, columns=["shard", "file", "records", "bytes", "sha256"])
        except BaseException as error:
            if roller:
                roller.abandon(error)
            raise

    return write


def write_warc(
    df: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    shard_bytes: int = 32 << 20,
    roll_bytes: int = 4 << 20,
    min_bytes: int = 0,
) -> DataFrame:
    """Write one record a row under ``root`` and return the manifest, a table that is stored there as well.

    ``shard_bytes``: bytes that a task writes, records' heads included, before compression; more where 4,096 tasks wouldn't do. ``roll_bytes``: compressed
    bytes after which a task goes on in a further file. ``min_bytes``: smaller payloads are responses every time.
    """
    spark = df.sparkSession
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit("").cast("binary"))
    pages = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    light = materialize(pages.select("id", "digest", F.octet_length("payload").cast("long").alias("n")), "payload-digests")
    ends = id_ranges(light.withColumn("n", F.col("n") + HEAD_BYTES), "id", "n", shard_bytes, True)
    # rows of one id are told apart by their payloads, so that an id with many of them goes to several tasks
    shard = range_of(F.col("id"), ends, F.conv(F.substring("digest", 1, 7), 16, 10).cast("long") * 8)
    # nulls last: a row with an id is the response before one without
    repeated = light.where(F.col("n") >= min_bytes).groupBy("digest").agg(F.min("id").alias("responder"), F.count("*").alias("c")).where("c > 1").drop("c")
    repeated = materialize(repeated, "repeated-payloads")
    markers = (
        light.where(F.col("n") >= min_bytes)
        .join(repeated, "digest")
        .where(~F.col("id").eqNullSafe(F.col("responder")))
        .select("id", "digest", "responder")
        .distinct()
        .select(shard.alias("shard"), "id", "digest", F.lit(0).alias("kind"), "responder", F.lit("").alias("url"), F.lit("").cast("binary").alias("payload"))
    )
    full = pages.select(shard.alias("shard"), "id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("responder"), "url", "payload")
    written = (
        full.unionByName(markers)
        .repartitionById(len(ends) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "id", "digest", "kind", "url")
        # ids as text: pandas would make floats of integers among nulls
        .select("shard", F.col("id").cast("string").alias("id"), "digest", "kind", F.col("responder").cast("string").alias("responder"), "url", "payload")
        .mapInPandas(_writer(root, date, roll_bytes, min_bytes), MANIFEST_SCHEMA)
    )
    written.write.parquet(f"{root}/_manifest")  # complete only when all files are
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/_manifest")


def members(stream) -> Iterator[bytes]:
    """The uncompressed records of a file of gzip members, one at a time."""
    unzip, parts = zlib.decompressobj(31), []
    data = stream.read(1 << 20)
    while data:
        parts.append(unzip.decompress(data))
        data = unzip.unused_data if unzip.eof else b""
        if unzip.eof:
            yield b"".join(parts)
            unzip, parts = zlib.decompressobj(31), []
        if not data:
            data = bytes(stream.read(1 << 20))
    if parts:
        raise ValueError("a WARC file ends inside a record")


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    if fields["WARC-Type"] == "warcinfo":
        return fields, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


RECORD_SCHEMA = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, refers_to_record string"


def _reader(root: str, with_payload: bool):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name in pdf["file"]:
                out, held = [], 0
                with read_stream(f"{root}/{name}") as stream:
                    for raw in members(stream):
                        fields, http, payload = parse(raw)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if fields["WARC-Type"] == "response" and (base32_sha1(payload) != digest or len(payload) != int(http["Content-Length"])):
                            raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
                        number = lambda k: int(fields[k]) if k in fields else None  # noqa: B023, E731
                        row = (number("X-Page-Id"), unquote(fields.get("WARC-Target-URI", "")), int(http["Content-Length"]), digest, fields["WARC-Type"], number("X-Refers-To-Page-Id"), fields["WARC-Record-ID"], fields.get("WARC-Refers-To"))
                        out.append((*row, payload) if with_payload else row)
                        held += len(payload) if with_payload else 200
                        if held > 8 << 20:
                            yield _frame(out, with_payload)
                            out, held = [], 0
                if out:
                    yield _frame(out, with_payload)

    return read


def _frame(rows: list[tuple], with_payload: bool) -> pd.DataFrame:
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")] + ["payload"] * with_payload
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def read_warc(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """The records of the files in the manifest under ``root``; digests and lengths are checked on the way."""
    files = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/_manifest").select("file")
    n = max(1, files.count())
    schema = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    return files.repartition(n, "file").mapInPandas(_reader(root, with_payload), schema)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), root)
    return read_warc(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id", "refers_to_record")
