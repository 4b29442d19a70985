"""WARC archives as a Spark data source: written in tasks, read by header first.

``register(spark)`` makes the format ``warc`` known. Reading plans one partition per
archive file, or per pack of small ones; filters on the record type and on single
headers are taken over by the source, which parses the headers of each record, and
passes over the payload of a record that is not wanted without reading it. Payloads
are read and decoded only where option ``payload`` is ``text`` (the default); with
``none`` the column is null.

Records are gzip members of their own (option ``compression`` ``none``: plain records),
whose header tells the member's length, so a packed payload is passed over as well.

Each task writes files of its own name, and a file starts anew beyond
``max_file_bytes``. Each commit lists the files of the tasks that succeeded in a
manifest of its own, and readers look only there, so what a lost executor left behind
is never read. An append adds a manifest; an overwrite's manifest replaces those before
it, whose files stay for readers that have planned them. Manifests name files, not records.

Archives of others are read as well: the path may be a file, a pattern or a folder.
In folders without a manifest all ``*.warc`` and ``*.warc.gz`` files are read, at any
depth. Gzip members without a length, or with many records, are unpacked to be passed over.

Defined results: a null payload is written as an empty one; headers with null values
are left out; an empty table gives a manifest without files and reads as no rows. A
payload of any length is held once by the task that writes or decodes it. A path without
anything raises, as does an archive that ends within a record that is read.
"""

from __future__ import annotations

import datetime as dt
import gzip
import io
import json
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter,
                                    In, InputPartition, IsNotNull, WriterCommitMessage)
from pyspark.sql.types import StructType

from tradewind.llm.frames import findable

VERSION = "WARC/1.1"
MANIFEST = "_manifest"
ENDINGS = (".warc", ".warc.gz")
MAX_FILE_BYTES = 64 << 20
READ_BYTES = 1 << 14
LEVEL = 3
PACK_BYTES = 32 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SMALLEST_REVISIT = 100

SCHEMA = ("record_id string, record_type string, target_uri string, date string, "
          "payload_digest string, refers_to string, payload_bytes long, content_length long, "
          "payload string")
# Columns that are header fields of their own.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type",
           "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
           "payload_bytes": "X-Payload-Bytes", "content_length": "Content-Length"}
NUMBERS = {"payload_bytes", "content_length"}


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI and the path within it."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path):
        if path.startswith("file:"):
            return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _listed(system: pafs.FileSystem, folder: str, deep: bool = True) -> list[pafs.FileInfo]:
    selector = pafs.FileSelector(folder, allow_not_found=True, recursive=deep)
    return [f for f in system.get_file_info(selector) if f.is_file]


def _is_manifest(path: str) -> bool:
    name = posixpath.basename(path)
    return name.startswith(MANIFEST) and name.endswith(".json")


def _committed(system: pafs.FileSystem, manifests: list[str]) -> dict[str, int]:
    """Files, with their sizes, of the commits that no other commit replaces."""
    commits = {}
    for path in manifests:
        with system.open_input_stream(path) as source:
            commits[path] = json.loads(source.read())
    replaced = {posixpath.join(posixpath.dirname(path), old)
                for path, commit in commits.items() for old in commit["replaces"]}
    return {posixpath.join(posixpath.dirname(path), name): size
            for path, commit in commits.items() if path not in replaced
            for name, size in commit["files"]}


def archives(system: pafs.FileSystem, path: str) -> list[tuple[str, int]]:
    """Archive files, with their sizes, of a file, a folder or a pattern (``*``, ``?``, ``**``)."""
    info = system.get_file_info(path)
    if info.is_file:
        return [(path, info.size)]
    pattern = None
    if info.type == pafs.FileType.NotFound:
        fixed = re.match(r"[^*?\[]*", path).group()
        if fixed == path:
            raise FileNotFoundError(path)
        pattern, path = path, posixpath.dirname(fixed) or "."
    listed = _listed(system, path)
    manifests = [f.path for f in listed if _is_manifest(f.path)]
    committed, own = _committed(system, manifests), {posixpath.dirname(m) for m in manifests}
    # A folder with manifests holds only what they name.
    found = [(f.path, f.size) for f in listed if f.path.endswith(ENDINGS)
             and (f.path in committed or posixpath.dirname(f.path) not in own)
             and (pattern is None or PurePosixPath(f.path).full_match(pattern))]
    if not found and (pattern or not manifests):
        raise FileNotFoundError(f"no archives in {pattern or path}")
    return sorted(found)


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", value)


def record_bytes(fields: dict, payload: bytes) -> bytes:
    lines = [VERSION]
    lines += [f"{HEADERS[k]}: {_clean(str(v))}" for k, v in fields.items() if v is not None]
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """A record as a gzip member whose header tells the member's length.

    The extra field ``sl`` holds the compressed and the plain length, so that a reader can
    pass over the member once it has seen the record's headers.
    """
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = struct.pack("<BBBBIBB", 0x1F, 0x8B, 8, 4, 0, 0, 255)
    extra = struct.pack("<H2sHII", 12, b"sl", 8, total, len(record) & 0xFFFFFFFF)
    return head + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class PlainRecords:
    """Records that are not compressed."""

    def __init__(self, source):
        self.source = source

    def headers(self) -> dict[str, str] | None:
        found = read_headers(self.source)
        self.left = int(found["content-length"]) + 4 if found else 0
        return found

    def payload(self) -> bytes:
        size = self.left - 4
        content = self.source.read(self.left)
        self.left = 0
        if len(content) < size:
            raise ValueError("the archive ends within a record")
        return content[:size]

    def next(self) -> None:
        self.source.seek(self.left, 1)


class PackedRecords:
    """Records in gzip members of their own; a payload is unpacked only when asked for.

    From the first member that does not tell its length on, the rest is one gzip stream.
    """

    def __init__(self, source):
        self.source = source
        self.stream: PlainRecords | None = None

    def _more(self) -> bool:
        if self.unpacker.eof:
            return False
        packed = self.unpacker.unconsumed_tail or self.source.read(READ_BYTES)
        if not packed:
            raise ValueError("the archive ends within a record")
        self.plain += self.unpacker.decompress(packed, READ_BYTES)
        return True

    def headers(self) -> dict[str, str] | None:
        if self.stream:
            return self.stream.headers()
        self.start = self.source.tell()
        head = self.source.read(12)
        if not head:
            return None
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("no gzip member starts here")
        extra = self.source.read(struct.unpack("<H", head[10:12])[0]) if head[3] & 4 else b""
        if head[3] != 4 or extra[:2] != b"sl" or len(extra) != 12:
            self.source.seek(self.start)
            self.stream = PlainRecords(gzip.GzipFile(fileobj=self.source))
            return self.stream.headers()
        self.length = struct.unpack("<I", extra[4:8])[0]
        self.unpacker = zlib.decompressobj(-15)
        self.plain = b""
        while (end := self.plain.find(b"\r\n\r\n")) < 0 and self._more():
            pass
        found = read_headers(io.BytesIO(self.plain[:end + 4]))
        self.plain = self.plain[end + 4:]
        self.size = int(found["content-length"])
        return found

    def payload(self) -> bytes:
        if self.stream:
            return self.stream.payload()
        while len(self.plain) < self.size and self._more():
            pass
        return self.plain[:self.size]

    def next(self) -> None:
        if self.stream:
            self.stream.next()
        else:
            self.source.seek(self.start + self.length)


def records_of(source) -> PlainRecords | PackedRecords:
    start = source.read(2)
    source.seek(0)
    return PackedRecords(source) if start == b"\x1f\x8b" else PlainRecords(source)


def read_headers(stream) -> dict[str, str] | None:
    """Headers of the record that starts here, by lower-case name; None at the end."""
    while (line := stream.readline()) in (b"\r\n", b"\n"):
        pass
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record starts with {line[:40]!r}")
    found: dict[str, str] = {}
    name = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError("the archive ends within a record's headers")
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and name:
            found[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        found[name] = value.strip()
    return found


@dataclass
class Written(WriterCommitMessage):
    files: list


@dataclass
class Pack(InputPartition):
    files: list


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, schema: StructType, max_bytes: int, packed: bool,
                 overwrite: bool):
        self.path, self.names, self.max_bytes = path.rstrip("/"), schema.names, max_bytes
        self.packed, self.overwrite = packed, overwrite
        unknown = set(self.names) - set(HEADERS) - {"payload"}
        if unknown:
            raise ValueError(f"no WARC columns: {sorted(unknown)}")

    def write(self, iterator) -> Written:
        system, root = filesystem(self.path)
        system.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        try:
            for row in iterator:
                fields = {c: row[c] for c in self.names
                          if c not in ("payload", "content_length")}
                payload = (row["payload"] or "").encode() if "payload" in self.names else b""
                record = record_bytes(fields, payload)
                if self.packed:
                    record = member(record)
                if out is None or size + len(record) > self.max_bytes and size:
                    if out is not None:
                        out.close()
                    suffix = "warc.gz" if self.packed else "warc"
                    files.append([f"{uuid.uuid4().hex}.{suffix}", 0])
                    # The members are packed already.
                    out = system.open_output_stream(f"{root}/{files[-1][0]}", compression=None)
                    size = 0
                out.write(record)
                size += len(record)
                files[-1][1] = size
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages) -> None:
        system, root = filesystem(self.path)
        system.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        old = [f.base_name for f in _listed(system, root, deep=False) if _is_manifest(f.path)]
        commit = {"files": files, "replaces": sorted(old) if self.overwrite else []}
        # Readers see a whole manifest or none.
        name = f"{MANIFEST}-{uuid.uuid4().hex}"
        with system.open_output_stream(f"{root}/{name}.writing") as out:
            out.write(json.dumps(commit).encode())
        system.move(f"{root}/{name}.writing", f"{root}/{name}.json")

    def abort(self, messages) -> None:
        system, root = filesystem(self.path)
        for name, _ in (f for m in messages if m is not None for f in m.files):
            system.delete_file(f"{root}/{name}")


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, payload: str):
        self.path, self.names, self.payload = path.rstrip("/"), schema.names, payload
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        """Equality and membership on header columns are decided here."""
        rest = []
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = ({f.value} if isinstance(f, EqualTo) else set(f.value)
                      if isinstance(f, In) else None)
            if column in HEADERS and column not in NUMBERS and values is not None:
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                rest.append(f)
        return [f for f in rest
                if not (isinstance(f, IsNotNull) and f.attribute[0] in self.wanted)]

    def partitions(self) -> Sequence[InputPartition]:
        system, root = filesystem(self.path)
        packs, size = [[]], 0
        for name, length in sorted(archives(system, root), key=lambda f: -f[1]):
            if packs[-1] and size + length > PACK_BYTES:
                packs.append([])
                size = 0
            packs[-1].append(name)
            size += length
        return [Pack(p) for p in packs]

    def read(self, partition: Pack) -> Iterator[tuple]:
        system, _ = filesystem(self.path)
        for name in partition.files:
            with system.open_input_file(name) as source:
                yield from self.records(io.BufferedReader(source, 1 << 16))

    def records(self, source) -> Iterator[tuple]:
        records = records_of(source)
        while (headers := records.headers()) is not None:
            row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
            if all(row[c] in values for c, values in self.wanted.items()):
                row["payload"] = (records.payload().decode("utf-8", "replace")
                                  if self.payload == "text" else None)
                for c in NUMBERS:
                    row[c] = None if row[c] is None else int(row[c])
                yield tuple(row[c] for c in self.names)
            records.next()


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, self.options.get("payload", "text"))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema,
                          int(self.options.get("max_file_bytes", MAX_FILE_BYTES)),
                          self.options.get("compression", "gzip") == "gzip", overwrite)


def register(spark: SparkSession) -> None:
    findable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read(spark: SparkSession, path: str, payload: str = "text") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def write(df: DataFrame, path: str, max_file_bytes: int = MAX_FILE_BYTES,
          compression: str = "gzip", mode: str = "append") -> None:
    """Add records to the archives of a folder, or with ``mode`` ``overwrite`` replace them."""
    register(df.sparkSession)
    (df.write.format("warc").option("max_file_bytes", max_file_bytes)
     .option("compression", compression).mode(mode).option("path", path).save())


def as_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", date: str | None = None,
               smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """Response and revisit records of pages.

    Among pages whose payloads are equal and have ``smallest`` bytes or more, those with
    the smallest id are responses, the others revisits of it, without a payload. A null
    payload is empty; a null id is never a response that others refer to, so a page
    without one is a response itself. Repeated rows of the smallest id are responses.
    """
    moment = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    html = F.coalesce(F.col(html_col), F.lit(""))
    plain = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("target_uri"),
                         html.alias("payload"))
    plain = plain.withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"),
        "digest": F.sha2(F.encode("payload", "UTF-8"), 256)})
    # Ids alone are summed up, and only digests that several ids share are joined back.
    firsts = (plain.where((F.col("payload_bytes") >= smallest) & F.col("id").isNotNull())
              .groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
              .where("first <> last").select("digest", "first"))
    seen = plain.join(firsts, "digest", "left")
    revisit = F.coalesce(F.col("id") != F.col("first"), F.lit(False))
    return seen.select(
        F.col("id").cast("string").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit(moment).alias("date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(revisit, F.col("first").cast("string")).alias("refers_to"),
        "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"))
