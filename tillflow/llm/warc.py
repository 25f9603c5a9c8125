"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing: each task writes one archive of records that are gzip members of their
own, and the commit writes a manifest that lists the archives of the tasks that
succeeded, with split points about every SPLIT_BYTES. Archives of failed or
repeated tasks are in no manifest and never read.

Reading: partitions are the stretches between split points; archives without a
manifest are one partition each. Of a record the header is inflated and parsed
first. Filters on record_type, record_id, refers_to, target_uri and payload_digest
are pushed down and decided on the header; the payload is inflated no further
than needed to find the record's end, and kept and decoded only for records that
pass and only if the ``payload`` option asks for it.
"""

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tillflow.llm.common import new_path, staged

SCHEMA = (
    "record_type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes long, payload binary"
)
SPLIT_BYTES = 32 << 20
MANIFEST = "_manifest.json"
_CHUNK = 1 << 16
# Names of header fields. The last is ours: a revisit has no payload to measure.
_FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Full-Payload-Length",
}
_DATE = "2000-01-01T00:00:00Z"  # records carry no time of their own; a fixed one keeps archives repeatable
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _files(path: str):
    """File system and plain path of a folder; any store that pyarrow reaches."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ----------------------------------------------------------------------------


def record_bytes(row: dict) -> bytes:
    """One WARC/1.1 record. A null payload is an empty block; line ends in header values become spaces."""
    payload = bytes(row.get("payload") or b"")
    fields = {name: row.get(column) for column, name in _FIELDS.items()}
    if fields["WARC-Payload-Digest"]:
        fields["WARC-Payload-Digest"] = "sha1:" + fields["WARC-Payload-Digest"]
    fields |= {"WARC-Date": _DATE, "Content-Type": "text/html", "Content-Length": len(payload)}
    if row.get("record_type") == "revisit":
        fields["WARC-Profile"] = _PROFILE
    lines = [f"{k}: {' '.join(str(v).splitlines())}" for k, v in fields.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, "", ""]).encode()
    return head + payload + b"\r\n\r\n"


@dataclass
class _Archive(WriterCommitMessage):
    name: str
    splits: list[int]


class _Writer(DataSourceWriter):
    def __init__(self, path: str, level: int):
        self._path, self._level = path, level

    def write(self, rows: Iterator) -> WriterCommitMessage:
        store, folder = _files(self._path)
        store.create_dir(folder, recursive=True)
        name, splits, at = f"part-{uuid.uuid4().hex}.warc.gz", [0], 0
        with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for row in rows:
                packer = zlib.compressobj(self._level, wbits=31)
                data = packer.compress(record_bytes(row.asDict())) + packer.flush()
                if at - splits[-1] >= SPLIT_BYTES:
                    splits.append(at)
                out.write(data)
                at += len(data)
        return _Archive(name, [*splits, at] if at else [])

    def commit(self, messages: list) -> None:
        store, folder = _files(self._path)
        store.create_dir(folder, recursive=True)
        listed = {m.name: m.splits for m in messages if m and m.splits}
        with store.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list) -> None:
        """Nothing to undo: without a manifest the archives of this write aren't known."""


# --- reading -----------------------------------------------------------------------------


@dataclass
class _Stretch(InputPartition):
    name: str
    start: int
    stop: int | None


class _Inflated:
    """The records of a stretch of an archive: inflates as far as it is asked to."""

    def __init__(self, file, start: int, stop: int | None, packed: bool):
        self._file, self._left = file, None if stop is None else stop - start
        file.seek(start)
        self._packed, self._raw, self._data = packed, b"", b""
        self._zip = zlib.decompressobj(wbits=31) if packed else None

    def _fill(self) -> bool:
        """Adds to the data at hand; False at the end."""
        if self._packed and not self._raw and not self._zip.eof:
            held = self._zip.decompress(b"", _CHUNK)
            if held:
                self._data += held
                return True
        if not self._raw:
            n = _CHUNK if self._left is None else min(_CHUNK, self._left)
            self._raw = self._file.read(n) if n else b""
            if self._left is not None:
                self._left -= len(self._raw)
            if not self._raw:
                return False
        if not self._packed:
            self._data, self._raw = self._data + self._raw, b""
            return True
        if self._zip.eof:
            self._zip = zlib.decompressobj(wbits=31)
        self._data += self._zip.decompress(self._raw, _CHUNK)
        self._raw = self._zip.unused_data if self._zip.eof else self._zip.unconsumed_tail
        return True

    def head(self) -> dict[str, str] | None:
        while True:
            self._data = self._data.lstrip(b"\r\n")
            end = self._data.find(b"\r\n\r\n")
            if end >= 0:
                break
            if not self._fill():
                return None
        lines = self._data[:end].decode("utf-8", "replace").split("\r\n")[1:]
        self._data = self._data[end + 4 :]
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}

    def block(self, length: int, keep: bool) -> bytes | None:
        """The next ``length`` bytes, or None after passing over them."""
        parts = [] if keep else None
        while length:
            if not self._data and not self._fill():
                raise ValueError("the archive ends within a record")
            part, self._data = self._data[:length], self._data[length:]
            length -= len(part)
            if keep:
                parts.append(part)
        return b"".join(parts) if keep else None


class _Reader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self._path, self._payload = path, payload
        self._wanted: dict[str, set | None] = {}  # None: any value but null

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802  (name given by the interface)
        for one in filters:
            column = one.attribute[0] if len(one.attribute) == 1 else None
            if column not in _FIELDS or column == "payload_bytes":
                yield one
            elif isinstance(one, EqualTo):
                self._narrow(column, {one.value})
            elif isinstance(one, In):
                self._narrow(column, set(one.value))
            else:
                if isinstance(one, IsNotNull):
                    self._wanted.setdefault(column, None)
                yield one

    def _narrow(self, column: str, values: set) -> None:
        before = self._wanted.get(column)
        self._wanted[column] = values if before is None else values & before

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, folder = _files(self._path)
        listed = store.get_file_info(f"{folder}/{MANIFEST}")
        if listed.type == fs.FileType.File:
            with store.open_input_stream(listed.path, compression=None) as file:
                known = json.loads(file.read())
            return [
                _Stretch(name, a, b)
                for name, splits in sorted(known.items()) for a, b in zip(splits, splits[1:], strict=False)
            ] or [_Stretch("", 0, 0)]
        found = store.get_file_info(fs.FileSelector(folder))
        names = sorted(x.base_name for x in found if x.base_name.endswith((".warc", ".warc.gz")))
        return [_Stretch(name, 0, None) for name in names] or [_Stretch("", 0, 0)]

    def _passes(self, row: dict) -> bool:
        return all(
            row[column] is not None and (values is None or row[column] in values)
            for column, values in self._wanted.items()
        )

    def read(self, partition: _Stretch) -> Iterator[tuple]:
        if not partition.name:
            return
        store, folder = _files(self._path)
        with store.open_input_file(f"{folder}/{partition.name}") as file:
            records = _Inflated(file, partition.start, partition.stop, partition.name.endswith(".gz"))
            while (head := records.head()) is not None:
                row = {column: head.get(name.lower()) for column, name in _FIELDS.items()}
                length = int(head.get("content-length", 0))
                if row["payload_digest"]:
                    row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
                row["payload_bytes"] = int(row["payload_bytes"] or length)
                passes = self._passes(row)
                payload = records.block(length, passes and self._payload)
                if passes:
                    yield (*row.values(), payload)


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` ("true" to read payloads, null otherwise); ``level`` of compression."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("payload", "false").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], int(self.options.get("level", 1)))


# --- the operator ----------------------------------------------------------------------


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of the archives in a folder; filters on header columns reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_warc(records: DataFrame, path: str) -> None:
    """Writes rows of SCHEMA to a new folder."""
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").save(path)


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_bytes: int = 0
) -> DataFrame:
    """A record for each page: a response, or a revisit of the page with an equal payload and the smallest id.

    Payloads below ``revisit_bytes`` bytes are always responses. Null html is an
    empty payload, a null url leaves the field out. Rows without an id are
    responses without a record id. Rows that share an id are records each, and
    with one payload they are all responses if the id is its smallest. Other
    columns aren't read. An empty table gives an empty result.

    Smallest ids are combined per digest before the shuffle. Only payloads that
    occur twice or more are joined back; if those are few, the pages don't move,
    else adaptive execution splits the join where most pages have one payload.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n"), F.unhex(F.sha1("payload")).alias("digest"))
    first = staged(
        rows.filter(F.col("id").isNotNull() & (F.col("n") >= revisit_bytes))
        .groupBy("digest", "n").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .filter("pages > 1").select("digest", "n", "first"),
        "first-payloads",
    )
    found = rows.join(first, ["digest", "n"], "left")
    again = F.coalesce(F.col("id") != F.col("first"), F.lit(False))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    return found.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        name("id").alias("record_id"),
        F.when(again, name("first")).alias("refers_to"),
        F.col("url").alias("target_uri"),
        base32(F.col("digest")).alias("payload_digest"),
        F.col("n").alias("payload_bytes"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def base32(digest: Column) -> Column:
    """A 20-byte digest in base 32, as text: 32 digits of five bits, eight for each 40."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = []
    for start in range(0, 20, 5):
        number = F.conv(F.hex(F.substring(digest, start + 1, 5)), 16, 10).cast("long")
        groups += [
            F.substring(F.lit(digits), F.shiftright(number, shift).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
            for shift in range(35, -1, -5)
        ]
    return F.concat(*groups)


def page_id(column: str) -> Column:
    """The page id in a record id."""
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
