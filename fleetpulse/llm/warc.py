"""WARC archives: writing whole-file gzip streams, normalising them, reading by offset.

``write_monolithic`` puts the records of a task into one gzip stream, as many
crawlers and repackers do; such a file can only be read from its start.
``normalise`` inflates each file once, record by record, rewrites every record
as a gzip member of its own and writes a sidecar index with the members'
offsets. ``read_records`` then reads members by offset. Files live in a folder
that driver and executors share; each is written by one task and moved into
place, so a task may run again.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, bytes_of, make_folder, map_batches, one_per_task, publish, shared_files
from fleetpulse.operators.lookup import lookup_join
from fleetpulse.sinks.tables import materialize

REVISIT_BYTES = 1000
LEVEL = 6
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 20
_READ = 1 << 16  # what is left of it is copied for every member
_SAFE = "!#$%&'()*+,/:;=?@[]~-._"
FILES_SCHEMA = "file string, n_records bigint"


def deduplicated(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with payload_bytes, payload_digest, record_type and refers_to.

    The payload is the html in UTF-8 (null: empty). Of equal payloads of at
    least ``least_bytes`` the rows with the largest page_id are responses and
    the others revisit it; a row without page_id revisits like any other, and
    rows that all lack one are responses. Digests with copies are summed before
    any shuffle; a digest with many copies is split.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("html"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"),
    )
    large = rows.filter(F.col("payload_bytes") >= least_bytes)
    groups = large.groupBy("payload_digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies"))
    keepers = materialize(groups.filter("copies > 1 AND keeper IS NOT NULL").drop("copies"), "keepers")
    joined = lookup_join(rows, keepers, "payload_digest", "page_id", how="left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"),
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    name = (identifier or "").removeprefix("<urn:page:").removesuffix(">")
    return None if name in ("", "none") else int(name)


def digest_field(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def hex_digest(field: str) -> str:
    return base64.b32decode(field.removeprefix("sha1:")).hex()


def make_record(page: dict, payload: bytes, date: str) -> bytes:
    """One record. A revisit has the response's header only, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['payload_bytes']}\r\n\r\n".encode()
    revisit = page["record_type"] == "revisit"
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", page["record_type"]),
        ("WARC-Record-ID", record_id(page["page_id"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(page["url"] or "urn:unknown", safe=_SAFE)),
        ("WARC-Payload-Digest", digest_field(page["payload_digest"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[2:2] = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(page["refers_to"]))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def write_monolithic(pages: DataFrame, uri: str, date: str = "1970-01-01T00:00:00Z") -> list[tuple[str, int]]:
    """Writes deduplicated pages, one gzip stream a task; returns the files and their records.

    A task holds one batch of pages. An empty table gives no file.
    """

    def write(batches: Batches) -> Batches:
        name = f"crawl-{TaskContext.get().partitionId():05d}.warc.gz"
        count = 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return

        def stream(out: pa.NativeFile) -> None:
            nonlocal count
            with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=LEVEL, mtime=0) as packed:
                batch = first
                while batch is not None:
                    facts = batch.drop_columns(["html"]).to_pylist()
                    for page, payload in zip(facts, bytes_of(batch, "html")):
                        packed.write(make_record(page, payload, date))
                    count += batch.num_rows
                    batch = next(batches, None)

        publish(f"{uri}/{name}", stream)
        yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [count]})

    make_folder(uri)
    return sorted(tuple(r) for r in map_batches(pages, write, FILES_SCHEMA).collect())


@dataclass
class Inflated:
    """The bytes of a gzip file (any number of members), inflated once from start to end."""

    source: pa.NativeFile
    buffer: bytes = b""
    at: int = 0

    def __post_init__(self):
        self._member = zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            if self._member.eof:
                rest = self._member.unused_data or self.source.read(_READ)
                if not rest:
                    return False
                self._member = zlib.decompressobj(31)
            else:
                rest = self._member.unconsumed_tail or self.source.read(_READ)
                if not rest:
                    return False
            got = self._member.decompress(rest, _CHUNK)
            if got:
                self.buffer, self.at = self.buffer[self.at :] + got, 0
                return True

    def through(self, mark: bytes) -> bytes:
        """Up to and including the mark; empty at the end of the file."""
        seen = 0
        while (end := self.buffer.find(mark, self.at + max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer) - self.at
            if not self._more():
                if self.buffer[self.at :].strip():
                    raise ValueError("the archive ends inside a record")
                return b""
        return self.take(end + len(mark) - self.at)

    def take(self, size: int) -> bytes:
        parts, have = [], len(self.buffer) - self.at
        while have < size:
            parts.append(self.buffer[self.at :])
            self.buffer, self.at = b"", 0
            if not self._more():
                raise ValueError("the archive ends inside a record")
            have += len(self.buffer)
        end = len(self.buffer) - (have - size)
        parts.append(self.buffer[self.at : end])
        self.at = end
        return b"".join(parts)


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def records_in(source: pa.NativeFile) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and whole bytes of each record, in file order; one record at a time."""
    stream = Inflated(source)
    while head := stream.through(b"\r\n\r\n"):
        head = head.lstrip(b"\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = fields_of(head)
        yield fields, head + stream.take(int(fields["content-length"]) + 4)


def normalise(spark: SparkSession, files: list[tuple[str, int]], source_uri: str, target_uri: str) -> list[tuple[str, int]]:
    """Rewrites each file with a gzip member for every record, and an index beside it.

    The index (``.idx.json`` lines) has each record's offset, member length, type,
    id and target. One task inflates one file, once; memory holds one record.
    """

    def rewrite(batches: Batches) -> Batches:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                index: list[dict] = []
                reader, path = shared_files(f"{source_uri}/{name}")

                def stream(out: pa.NativeFile) -> None:
                    at = 0
                    with reader.open_input_stream(path, compression=None) as source:
                        for fields, record in records_in(source):
                            member = gzip.compress(record, compresslevel=LEVEL, mtime=0)
                            out.write(member)
                            entry = {"offset": at, "length": len(member), "type": fields["warc-type"]}
                            index.append(entry | {"id": fields["warc-record-id"], "target": unquote(fields["warc-target-uri"])})
                            at += len(member)

                publish(f"{target_uri}/{name}", stream)
                lines = "".join(json.dumps(x) + "\n" for x in index).encode()
                publish(f"{target_uri}/{name}.idx.json", lambda out: out.write(lines))
                yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [len(index)]})

    make_folder(target_uri)
    if not files:
        return []
    done = map_batches(one_per_task(spark, files, FILES_SCHEMA), rewrite, FILES_SCHEMA)
    return sorted(tuple(r) for r in done.collect())


def read_record(uri: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Fields and block of the record whose member lies at an offset."""
    files, path = shared_files(uri)
    with files.open_input_file(path) as file:
        return _record_at(file, offset, length)


def _record_at(file: pa.NativeFile, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    file.seek(offset)
    record = gzip.decompress(file.read(length))
    head, _, block = record.partition(b"\r\n\r\n")
    return fields_of(head), block[: -len(b"\r\n\r\n")]


def read_records(spark: SparkSession, files: list[tuple[str, int]], uri: str, with_payload: bool = False) -> DataFrame:
    """One row per record of normalised files, each read by its index entry.

    page_id, payload_bytes, payload_digest, record_type, refers_to, file, offset
    and, if asked for, the payload (null for revisits). A response whose payload
    does not match its length or digest raises.
    """
    names = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, file string, offset bigint"
    names += ", payload binary" if with_payload else ""
    if not files:
        return spark.createDataFrame([], names)
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in names.split(", "))])

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                system, path = shared_files(f"{uri}/{name}")
                with system.open_input_stream(f"{path}.idx.json", compression=None) as lines:
                    index = [json.loads(line) for line in lines.read().splitlines()]
                with system.open_input_file(path) as file:
                    for low in range(0, len(index), 200):
                        rows = [_row(name, x["offset"], *_record_at(file, x["offset"], x["length"])) for x in index[low : low + 200]]
                        yield pa.RecordBatch.from_pylist([{n: r[n] for n in types.names} for r in rows], schema=types)

    return map_batches(one_per_task(spark, files, FILES_SCHEMA), read, names)


def _row(name: str, offset: int, fields: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(fields_of(http)["content-length"]), hex_digest(fields["warc-payload-digest"])
    response = fields["warc-type"] == "response"
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload does not match its header")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": page_of(fields.get("warc-refers-to")),
        "file": name,
        "offset": offset,
        "payload": payload if response else None,
    }
