"""WARC archives as a Python data source: `spark.read.format("warc")` and `df.write.format("warc")`.

Writing: a task writes files of its own, each record a gzip member, and rolls to a new file at `file_bytes`. Names are never
used twice, and the job ends by writing the list of its files, so files of failed or repeated tasks are not read. The member
header holds the lengths of the member (the "sl" field for skipping), which other readers ignore.

Reading: a partition is a file. Predicates on the record type and other headers are pushed down; headers are parsed first, and
the payload of a record that is not wanted, by predicate or by the option `payload`, is neither inflated nor copied where the
lengths are known. Plain and gzipped files of other writers are read too.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from armature.operators.smallside import cut_lineage

LIST = "_archives.json"
SCHEMA = (
    "warc_type string, record_id string, target_uri string, warc_date string, refers_to string, content_type string, "
    "payload_digest string, payload_length long, headers map<string,string>, payload binary, file string, file_offset long"
)
#: Column -> header, in lower case.
HEADERS = {
    "warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "warc_date": "warc-date",
    "refers_to": "warc-refers-to", "content_type": "content-type", "payload_digest": "warc-payload-digest",
}
#: An extension header: the length of the full payload, also in revisit records.
LENGTH_HEADER = "X-Payload-Length"
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGEST_KIND = "sha256:"
BLOCK = 1 << 20


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path, by scheme; a path without one is local."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


# ---- records --------------------------------------------------------------------------------------------------------


def one_line(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in value)


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {one_line(v)}" for k, v in fields if v is not None], f"Content-Length: {len(block)}", "", ""]
    return b"".join(("\r\n".join(lines).encode(), block, b"\r\n\r\n"))


def member(raw: bytes, level: int) -> bytes:
    """One gzip member whose header tells its lengths."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    size = 24 + len(body) + 8
    lengths = (size, len(raw)) if max(size, len(raw)) < 1 << 32 else (0, 0)
    head = struct.pack("<BBBBIBBH2sHII", 0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"sl", 8, *lengths)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def member_size(head: bytes) -> int:
    """Length of the member that begins with `head`, or 0 if its header does not tell."""
    if len(head) >= 24 and head[3] & 4 and head[12:14] == b"sl" and head[14:16] == b"\x08\x00":
        return struct.unpack("<I", head[16:20])[0]
    return 0


def parse_headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            out[last] = value.strip()
    return out


class Blocks:
    """Ranges of a file, read a block at a time."""

    def __init__(self, handle, size: int):
        self.handle, self.size, self.low, self.held = handle, size, 0, b""

    def get(self, at: int, count: int) -> bytes:
        count = min(count, self.size - at)
        if at < self.low or at + count > self.low + len(self.held):
            self.handle.seek(at)
            self.low, self.held = at, self.handle.read(min(max(count, BLOCK), self.size - at))
        return self.held[at - self.low : at - self.low + count]


class Inflated:
    """A gzip member, inflated only as far as asked."""

    def __init__(self, blocks: Blocks, at: int):
        self.blocks, self.at, self.next = blocks, at, at
        self.machine, self.out, self.rest = zlib.decompressobj(31), bytearray(), b""

    def more(self, most: int = 0) -> bool:
        """At least some more output, if there is any; `most` bounds a step."""
        while not self.machine.eof:
            given = self.machine.unconsumed_tail or self.blocks.get(self.next, 65536)
            if not self.machine.unconsumed_tail:
                self.next += len(given)
            if not given:
                raise ValueError("a gzip member is cut off")
            found = self.machine.decompress(given, most)
            self.out += found
            if found:
                return True
        return False

    def end(self) -> int:
        """Where the next member begins; the rest is inflated and dropped."""
        while self.more(1 << 20):
            self.out.clear()
        return self.next - len(self.machine.unused_data)


def records(handle, size: int, wanted, payload_of) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """(offset, headers, block) of the records that `wanted(headers)` takes; the block is None unless `payload_of(headers)`."""
    blocks, at = Blocks(handle, size), 0
    while at < size:
        start = blocks.get(at, 2)
        if start == b"\r\n":
            at += 2
            continue
        if start == b"\x1f\x8b":
            known = member_size(blocks.get(at, 24))
            unpacked = Inflated(blocks, at)
            while (cut := unpacked.out.find(b"\r\n\r\n")) < 0 and unpacked.more(4096):
                pass
            if cut < 0:
                raise ValueError("a record without headers")
            headers = parse_headers(bytes(unpacked.out[:cut]))
            take = wanted(headers)
            block = None
            if take and payload_of(headers):
                need = cut + 4 + int(headers.get("content-length", 0))
                while len(unpacked.out) < need and unpacked.more():
                    pass
                if len(unpacked.out) < need:
                    raise ValueError("a record is shorter than its length")
                block = bytes(unpacked.out[cut + 4 : need])
            here, at = at, at + known if known else unpacked.end()
        else:
            count = 4096
            while (cut := (head := blocks.get(at, count)).find(b"\r\n\r\n")) < 0 and count < min(1 << 24, size - at):
                count *= 2
            if cut < 0:
                raise ValueError("a record without headers")
            headers = parse_headers(head[:cut])
            take = wanted(headers)
            length = int(headers.get("content-length", 0))
            block = blocks.get(at + cut + 4, length) if take and payload_of(headers) else None
            here, at = at, at + cut + 4 + length + 4
        if take:
            yield here, headers, block


def payload_in(headers: dict[str, str], block: bytes) -> bytes:
    """The entity of an HTTP message, else the block itself."""
    if headers.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        return block[cut + 4 :] if cut >= 0 else b""
    return block


def field(column: str, headers: dict[str, str]) -> str | None:
    value = headers.get(HEADERS[column])
    return value[len(DIGEST_KIND) :] if column == "payload_digest" and value and value.startswith(DIGEST_KIND) else value


# ---- data source ----------------------------------------------------------------------------------------------------


@dataclass
class Archive(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        kinds = options.get("payload", "all")
        self.kinds = None if kinds == "all" else set() if kinds == "none" else set(kinds.split(","))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", [f.value]))
            elif isinstance(f, In):
                self.tests.append((column, "in", list(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "is", None))
            else:
                yield f

    def partitions(self):
        store, path = store_of(self.path)
        info = store.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [Archive(path)]
        listed = f"{path.rstrip('/')}/{LIST}"
        if store.get_file_info(listed).type == pafs.FileType.File:
            with store.open_input_stream(listed) as f:
                names = json.loads(f.read())
            return [Archive(f"{path.rstrip('/')}/{n}") for n in names]
        found = store.get_file_info(pafs.FileSelector(path, recursive=True)) if info.type == pafs.FileType.Directory else []
        return [Archive(x.path) for x in sorted(found, key=lambda x: x.path) if x.path.endswith((".warc", ".warc.gz"))]

    def wanted(self, headers: dict[str, str]) -> bool:
        for column, test, value in self.tests:
            have = field(column, headers)
            if have is None or test == "in" and have not in value or test == "starts" and not have.startswith(value):
                return False
        return True

    def read(self, partition):
        if partition is None:  # nothing to read
            return
        store, _ = store_of(self.path)
        kind = pa.schema([(c, pa.string()) for c in HEADERS] + [("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("file", pa.string()), ("file_offset", pa.int64())])
        order = ["warc_type", "record_id", "target_uri", "warc_date", "refers_to", "content_type", "payload_digest", "payload_length", "headers", "payload", "file", "file_offset"]
        kind = pa.schema([kind.field(n) for n in order])
        rows, held = [], 0
        batch = lambda: pa.RecordBatch.from_pylist(rows, kind)
        with store.open_input_file(partition.path) as handle:
            of = lambda h: self.kinds is None or h.get("warc-type") in self.kinds
            for offset, headers, block in records(handle, handle.size(), self.wanted, of):
                payload = None if block is None else payload_in(headers, block)
                length = headers.get(LENGTH_HEADER.lower())
                row = {c: field(c, headers) for c in HEADERS}
                row |= {"payload_length": int(length) if length is not None else None if payload is None else len(payload), "headers": list(headers.items()), "payload": payload, "file": partition.path, "file_offset": offset}
                rows.append(row)
                held += len(payload or b"") + 1000
                if held >= 8 << 20:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows of (warc_type, record_id, target_uri, warc_date, refers_to, payload_digest, payload_length, payload)."""

    def __init__(self, options):
        self.path = options["path"]
        self.level = int(options.get("level", 4))
        self.file_bytes = int(options.get("file_bytes", 64 << 20))

    def write(self, iterator) -> Written:
        store, path = store_of(self.path)
        store.create_dir(path, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            columns = batch.schema.names
            for at in range(batch.num_rows):
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{path.rstrip('/')}/{names[-1]}", compression=None), 0
                data = member(self._record({c: batch.column(i)[at].as_py() for i, c in enumerate(columns)}), self.level)
                out.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    @staticmethod
    def _record(row: dict) -> bytes:
        payload = row.get("payload") or b""
        digest = row.get("payload_digest")
        fields = [
            ("WARC-Type", row["warc_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["warc_date"]), ("WARC-Target-URI", row.get("target_uri")),
            ("WARC-Payload-Digest", None if digest is None else DIGEST_KIND + digest), (LENGTH_HEADER, str(row["payload_length"])),
        ]
        if row["warc_type"] == "revisit":
            fields += [("WARC-Refers-To", row["refers_to"]), ("WARC-Profile", REVISIT_PROFILE)]
            return record(fields, b"")
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        return record([*fields, ("Content-Type", "application/http; msgtype=response")], head + payload)

    def commit(self, messages) -> None:
        """The list of files makes them visible; it is written aside and moved, so it is there whole or not at all."""
        store, path = store_of(self.path)
        store.create_dir(path, recursive=True)
        listed, aside = f"{path.rstrip('/')}/{LIST}", f"{path.rstrip('/')}/_{uuid.uuid4().hex}"
        names = sorted(n for m in messages if m is not None for n in m.names)
        if store.get_file_info(listed).type == pafs.FileType.File:  # an append
            with store.open_input_stream(listed) as f:
                names = sorted({*names, *json.loads(f.read())})
        with store.open_output_stream(aside) as f:
            f.write(json.dumps(names).encode())
        store.move(aside, listed)

    def abort(self, messages) -> None:
        """Files of a failed job are in no list and are never read."""


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("write to a new folder, or append")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archives(spark: SparkSession, path: str, payload: str = "all") -> DataFrame:
    """Records of a folder or file. `payload`: "all", "none", or the record types whose payload is wanted; others have null."""
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def write_archives(records_: DataFrame, path: str, **options) -> None:
    register(records_.sparkSession)
    records_.write.format("warc").options(**options).mode("append").save(path)


# ---- pages ----------------------------------------------------------------------------------------------------------

#: Shared payloads up to this many are broadcast (about 150 bytes each); more are joined by shuffle.
MOST_BROADCAST = 100_000


def page_records(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 100, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Rows for `write_archives`, one per page.

    Of pages with equal payloads of at least `least_bytes`, those with the smallest id are responses and the others revisit
    it; pages without an id revisit a page that has one, and are responses where none has. A null html is an empty payload, a
    null url gives no target. Other columns are not read. Rows that repeat an id give a record each.
    """
    body = F.encode(F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")), "UTF-8")
    full = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url}`").cast("string").alias("target_uri"), body.alias("payload"))
    full = full.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_length", F.octet_length("payload").cast("long"))
    large = full.filter(F.col("payload_length") >= least_bytes)
    shared = large.groupBy("payload_digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("pages")).filter((F.col("pages") > 1) & F.col("first_id").isNotNull()).drop("pages")
    shared = cut_lineage(shared)
    few = shared.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    joined = full.join(F.broadcast(shared) if few else shared, "payload_digest", "left")
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    again = F.col("first_id").isNotNull() & (F.col("payload_length") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        name(F.col("id")).alias("record_id"),
        "target_uri",
        F.lit(date).alias("warc_date"),
        F.when(again, name(F.col("first_id"))).alias("refers_to"),
        "payload_digest",
        "payload_length",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_id_of(record_id) -> F.Column:
    """The id in a record's name; null for a page without one."""
    return F.regexp_extract(record_id, "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")
