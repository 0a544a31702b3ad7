"""Operator 4: web archives. Pages to legacy ARC files, ARC files to WARC files, and both readers.

Archive files lie in the shared folder. A task writes files under names of its own and returns a
manifest row for each; the manifest is stored through Spark, so only files of tasks that ended well
are ever read, and a retried task leaves at worst a file that no manifest names. Readers stream:
one record at a time is in memory.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.columns import quoted
from ledgerlark.sources.scratch import new_path, stored

#: Field lists of the two versions of the ARC format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ITEM_FIELD = "X-Archive-Item"  # the caller's own id, carried in the archived HTTP head
NAMESPACE = uuid.UUID("6f0d7a52-93a5-5a0e-8f0b-1f4f5d0f7a11")
FILE_BYTES = 256 << 20
BATCH_BYTES = 8 << 20
START = datetime(2000, 1, 1)

MANIFEST = "path string, version int, records bigint"
ARC_RECORD = (
    "path string, at bigint, version int, url string, ip string, date string, mime string, "
    "item bigint, payload binary, payload_bytes bigint, digest string"
)
WARC_RECORD = (
    "path string, record_type string, record_id string, date string, url string, item bigint, "
    "payload binary, payload_bytes bigint, digest string, refers_to string, refers_to_item bigint"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*identity) -> str:
    """The same record always gets the same name, so a revisit can name a record of another file."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(31).join(map(str, identity)))}>"


def _full_uri(spark: SparkSession, path: str) -> str:
    """With the scheme of the store Spark would use for it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return str(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString())


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class _Files:
    """Gzip members, one a record, in files of bounded size."""

    def __init__(self, folder: str, suffix: str, version: int, opening):
        self.store, self.folder = _store(folder)
        self.scheme = folder.partition(":")[0]
        self.store.create_dir(self.folder, recursive=True)
        self.suffix, self.version, self.opening = suffix, version, opening
        self.out, self.done = None, []

    def write(self, record: bytes) -> None:
        if self.out is None or self.out.tell() >= FILE_BYTES:
            self.close()
            self.name = f"{uuid.uuid4().hex}.{self.suffix}.gz"
            self.path, self.records = f"{self.folder}/{self.name}", 0
            self.out = self.store.open_output_stream(self.path, compression=None)
            self.out.write(gzip.compress(self.opening(self.name), 3, mtime=0))
        self.out.write(gzip.compress(record, 3, mtime=0))
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.version, self.records))
            self.out = None


class _Rows:
    """Record batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size + 200
        if self.bytes >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, self.schema, strict=True)]
            self.rows, self.bytes = [], 0
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


_KINDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[k]) for n, k in (part.split(" ") for part in ddl.split(", "))])


def _values(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows one at a time, so that no second copy of a batch is made."""
    columns = [batch.column(i) for i in range(batch.num_columns)]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


# --- ARC -----------------------------------------------------------------------------------------


def write_arc(pages: DataFrame, *, item: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write every row as one ARC record; returns the stored manifest of the files.

    Each task writes version 1 and version 2 files, alternating over its rows. A null payload is
    empty; a null or empty URL is ``-``; blanks, control and line characters of a URL are
    percent-encoded, since the header line parts its fields by blanks.
    """
    spark = pages.sparkSession
    folder = _full_uri(spark, new_path(spark, "arc"))
    schema = _arrow(MANIFEST)

    def run(batches):
        files = {v: _Files(folder, "arc", v, _arc_opening(v)) for v in ARC_FIELDS}
        n = 0
        for batch in batches:
            for number, address, body in _values(batch):
                n += 1
                version = 1 + n % 2
                files[version].write(_arc_record(version, number, address, body or ""))
        for f in files.values():
            f.close()
        rows = _Rows(schema)
        for f in files.values():
            for done in f.done:
                yield from rows.add(done, 0)
        yield from rows.flush()

    chosen = pages.select(
        quoted(item).cast("bigint").alias("item"), quoted(url).alias("url"), quoted(payload).alias("payload")
    )
    return stored(chosen.mapInArrow(run, MANIFEST), "arc-manifest")


def _arc_opening(version: int):
    def opening(name: str) -> bytes:
        block = f"{version} 0 ledgerlark\n{ARC_FIELDS[version]}\n".encode()
        head = f"filedesc://{name} 0.0.0.0 {START:%Y%m%d%H%M%S} text/plain"
        extra = " 200 - - 0 " + name if version == 2 else ""
        return f"{head}{extra} {len(block)}\n".encode() + block + b"\n"

    return opening


def _arc_record(version: int, item: int | None, url: str | None, body: str) -> bytes:
    payload = body.encode()
    address = quote(url, safe="".join(map(chr, range(0x21, 0x7F)))) if url else "-"
    date = START + timedelta(seconds=(item or 0) % 500_000_000)
    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
    head += f"{ITEM_FIELD}: {item}\r\n" if item is not None else ""
    block = head.encode() + b"\r\n" + payload
    line = f"{address} 0.0.0.0 {date:%Y%m%d%H%M%S} text/html"
    if version == 2:
        line += f" 200 {hashlib.md5(block).hexdigest()} - 0 -"
    return f"{line} {len(block)}\n".encode() + block + b"\n"


def read_arc(manifest: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """The records of ARC files (``path`` column), parsed by the version each file declares.

    A header line is read by its version's fields from both ends, the block by its declared length.
    A file that breaks off inside a record, or declares no known version, raises.
    """
    spark, schema = manifest.sparkSession, _arrow(ARC_RECORD)

    def run(batches):
        rows = _Rows(schema)
        for batch in batches:
            for (path,) in _values(batch):
                for row in parse_arc(_lines_of(path), path, with_payload):
                    yield from rows.add(row, len(row[8] or b""))
        yield from rows.flush()

    return _spread(spark, manifest).mapInArrow(run, ARC_RECORD)


def _spread(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One file name a partition or so; the names are few and small next to what they name."""
    files = max(1, manifest.count())
    return manifest.select("path").repartition(min(files, 20_000))


def _lines_of(path: str):
    store, inner = _store(path if ":" in path.partition("/")[0] else f"file://{path}")
    return gzip.GzipFile(fileobj=store.open_input_stream(inner, compression=None))


def parse_arc(stream, path: str, with_payload: bool = True) -> Iterator[tuple]:
    opening = stream.readline().decode().split(" ")
    if not opening[0].startswith("filedesc://"):
        raise ValueError(f"{path}: no ARC version block")
    block = _exactly(stream, int(opening[-1]), path).decode()
    version = int(block.split(" ", 1)[0])
    if version not in ARC_FIELDS:
        raise ValueError(f"{path}: ARC version {version}")
    after_date = len(ARC_FIELDS[version].split(" ")) - 3  # fields from the type on
    at = 0
    while line := stream.readline():
        if line == b"\n":
            continue
        front = line.decode().rstrip("\n").split(" ")
        rest = front[-after_date:]
        url, ip, date = " ".join(front[: -after_date - 2]), *front[-after_date - 2 : -after_date]
        content = _exactly(stream, int(rest[-1]), path)
        head, payload = _http(content)
        item = head.get(ITEM_FIELD.lower())
        yield (
            path, at, version, "" if url == "-" else url, ip, date, rest[0],
            None if item is None else int(item), payload if with_payload else None,
            len(payload), sha1_base32(payload),
        )
        at += 1


def _exactly(stream, n: int, path: str) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise ValueError(f"{path}: a record ends after {len(data)} of {n} bytes")
    return data


def _http(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of an archived response; all payload if it has no HTTP head."""
    if not block.startswith(b"HTTP/"):
        return {}, block
    head, _, payload = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode(errors="replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}, payload


# --- WARC ----------------------------------------------------------------------------------------


def warc_date(arc_date: str) -> str:
    """ISO 8601 of a 14-digit ARC date; shorter ones are filled up from the year on."""
    filled = arc_date + "20000101000000"[len(arc_date):]
    return datetime.strptime(filled, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def arc_to_warc(manifest: DataFrame, *, revisit_bytes: int = 0) -> DataFrame:
    """Convert ARC files to WARC files; returns the stored manifest of the new files.

    Identifiers are derived from item, digest and the record's place in its ARC file, so that equal
    records have their own; timestamps, types and digests follow from the ARC fields. Of records with
    equal payloads of at least ``revisit_bytes`` bytes, those with the largest item are responses and
    the others revisits that refer to the last of these; all smaller ones are responses. Records without an item revisit an equal record
    that has one; among themselves they all stay responses.

    The groups of equal payloads are counted over digests alone, combined before the shuffle, and
    stored, so that the join with the payloads knows their true size: it sends them to the tasks if
    they are few, and else can split a digest that a third of all records share.
    """
    spark = manifest.sparkSession
    folder = _full_uri(spark, new_path(spark, "warc"))
    large = F.col("payload_bytes") >= revisit_bytes
    file = F.substring_index("path", "/", -1)
    groups = (
        read_arc(manifest, with_payload=False)
        .where(large)
        .groupBy("digest")
        .agg(F.max(F.struct("item", file.alias("file"), "at")).alias("kept"), F.count(F.lit(1)).alias("records"))
        .where((F.col("records") > 1) & F.col("kept.item").isNotNull())
        .select(F.col("digest").alias("shared"), "kept")
    )
    groups = stored(groups, "warc-groups")
    records = read_arc(manifest)
    decided = records.join(groups, (records["digest"] == groups["shared"]) & large, "left").select(
        file.alias("file"), "at", "url", "ip", "date", "mime", "item", "payload", "digest",
        F.when(~F.col("item").eqNullSafe(F.col("kept.item")), F.col("kept")).alias("refers_to"),
    )
    schema = _arrow(MANIFEST)

    def run(batches):
        files = _Files(folder, "warc", 1, _warc_opening)
        for batch in batches:
            for row in _values(batch):
                files.write(_warc_record(*row))
        files.close()
        rows = _Rows(schema)
        for done in files.done:
            yield from rows.add(done, 0)
        yield from rows.flush()

    return stored(decided.mapInArrow(run, MANIFEST), "warc-manifest")


def _warc_opening(name: str) -> bytes:
    body = b"software: ledgerlark\r\nformat: WARC File Format 1.1\r\n"
    return _warc_bytes(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", record_id("info", name)),
            ("WARC-Date", warc_date(f"{START:%Y%m%d%H%M%S}")),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ],
        body,
    )


def _warc_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", len(block))])
    return f"{WARC_VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _warc_record(file, at, url, ip, date, mime, item, payload, digest, refers_to) -> bytes:
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {mime}\r\nContent-Length: {len(payload)}\r\n"
    head += f"{ITEM_FIELD}: {item}\r\n" if item is not None else ""
    block = head.encode() + b"\r\n" + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(item, digest, file, at)),
        ("WARC-Date", warc_date(date)),
        ("WARC-Target-URI", url or "urn:unknown"),
        ("WARC-IP-Address", ip),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to["item"], digest, refers_to["file"], refers_to["at"])),
            ("X-Refers-To-Item", str(refers_to["item"])),
        ]
    return _warc_bytes(fields, block)


def read_warc(manifest: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """The response and revisit records of WARC files (``path`` column).

    A response's digest and size are those of the payload read, and a digest that differs from the
    declared one raises. A revisit's are the declared ones of the payload it stands for.
    """
    spark, schema = manifest.sparkSession, _arrow(WARC_RECORD)

    def run(batches):
        rows = _Rows(schema)
        for batch in batches:
            for (path,) in _values(batch):
                for row in parse_warc(_lines_of(path), path, with_payload):
                    yield from rows.add(row, len(row[6] or b""))
        yield from rows.flush()

    return _spread(spark, manifest).mapInArrow(run, WARC_RECORD)


def parse_warc(stream, path: str, with_payload: bool = True) -> Iterator[tuple]:
    while first := stream.readline():
        if first == b"\r\n":
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"{path}: not a WARC record: {first[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        block = _exactly(stream, int(fields["content-length"]), path)
        kind = fields["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        head, payload = _http(block)
        declared = fields["warc-payload-digest"].removeprefix("sha1:")
        size = len(payload)
        if kind == "revisit":
            size = int(head["content-length"])
        elif sha1_base32(payload) != declared:
            raise ValueError(f"{path}: digest of {fields['warc-record-id']}")
        item, to = head.get(ITEM_FIELD.lower()), fields.get("x-refers-to-item")
        yield (
            path, kind, fields["warc-record-id"], fields["warc-date"], fields["warc-target-uri"],
            None if item is None else int(item), payload if with_payload else None, size, declared,
            fields.get("warc-refers-to"), None if to is None else int(to),
        )
