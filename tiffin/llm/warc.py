"""WARC records in ZIP-packaged archives: writing, and reading by ranges without extraction.

An archive is a ZIP file with stored members: any number below ``archive/``, whose records are gzip members of
their own or plain, and any number below ``indexes/``, with lines of the offset, length and member of each
record. The member may be left out where there is only one, or where index and member have the same stem. The
writer makes one of each. A reader takes the end of the file, follows the (ZIP64) end record to the
central directory, the directory to the members, and the indexes to the records; a compressed member of these
folders, or one that no index names, is an error. Records are then read in runs of some ``run_bytes``, by as many
tasks as there are runs, so a large archive is not one task.

A task writes archives of at most some ``archive_bytes`` under a name of its own, and reports them only
once they are closed: a task that is lost or run twice leaves a file nobody lists. Files go through
pyarrow's file systems (local, HDFS, S3, GCS), below the shared folder.

Of records with equal payloads of at least ``least`` bytes, the one with the largest page_id is a
response and the others are revisits that refer to it and carry headers only.

Defined cases: a NULL page has an empty payload; a NULL url has no target header, and line breaks and
other control characters in one are escaped in the header; a NULL page_id counts as smaller than any
other, and a group that has no other is all responses; rows that repeat the largest page_id are responses
each; an empty table gives no archives and an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch

LEAST = 1000
ARCHIVE_BYTES = 64 << 20
RUN_BYTES = 1 << 20
TASK_BYTES = 64 << 20
CAPTURED = "2024-01-01T00:00:00Z"

# Member names, and the signatures and sizes of the ZIP format.
ARCHIVE, INDEXES = "archive/", "indexes/"
DATA, INDEX = f"{ARCHIVE}data.warc.gz", f"{INDEXES}index.txt"
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_END_SIZE, _LOCATOR_SIZE, _ENTRY_SIZE, _LOCAL_SIZE = 22, 20, 46, 30
_GZIP = b"\x1f\x8b"
_FULL32, _FULL16 = 0xFFFFFFFF, 0xFFFF


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system, as any process understands it."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:///", fs.makeQualified(hadoop_path).toString())


# Records


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, n_bytes: int,
           refers_to: int | None, captured: str = CAPTURED) -> bytes:
    """A response, or with ``refers_to`` a revisit, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {n_bytes}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": captured,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="!#$&'()*+,/:;=?@[]~")
    if refers_to is not None:
        head["WARC-Refers-To"] = _name(refers_to)
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return _gzip(lines.encode() + block + b"\r\n\r\n")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines.split(b"\r\n")[1:])
    return {name.decode().lower(): value.strip().decode() for name, _, value in pairs}


def parse(data: bytes) -> dict:
    """The fields of a record from its gzip member."""
    plain = zlib.decompress(data, 31) if data[:2] == _GZIP else data
    head, _, rest = plain.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = warc["warc-type"] == "revisit"
    return {
        "page_id": _number(warc["warc-record-id"]),
        "url": unquote(warc["warc-target-uri"]) if "warc-target-uri" in warc else None,
        "record_type": warc["warc-type"],
        "refers_to": _number(warc["warc-refers-to"]) if revisit else None,
        "declared_digest": warc["warc-payload-digest"].partition(":")[2],
        "declared_bytes": int(_headers(http)["content-length"]),
        "payload": None if revisit else payload,
    }


def _number(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


# Writing


class _Archive:
    """One archive being written; the index stays in memory until the data is complete."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self._stream = fs.open_output_stream(path)
        self._zip = zipfile.ZipFile(self._stream, "w", zipfile.ZIP_STORED)
        self._data = self._zip.open(DATA, "w", force_zip64=True)
        self._index: list[str] = []
        self.size = 0

    def add(self, data: bytes) -> None:
        self._index.append(f"{self.size} {len(data)} {DATA.removeprefix(ARCHIVE)}\n")
        self._data.write(data)
        self.size += len(data)

    def close(self) -> tuple[int, int]:
        self._data.close()
        self._zip.writestr(INDEX, "".join(self._index))
        self._zip.close()
        n_bytes = self._stream.tell()
        self._stream.close()
        return n_bytes, len(self._index)


def _writing(folder: str, archive_bytes: int, captured: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        archive, done = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for row in batch.slice(start, 64).to_pylist():
                    if archive is None:
                        name = f"pages-{uuid.uuid4().hex}.zip"
                        archive = _Archive(fs, f"{root}/{name}")
                    archive.add(record(**row, captured=captured))
                    if archive.size >= archive_bytes:
                        done.append((f"{folder}/{name}", *archive.close()))
                        archive = None
        if archive is not None:
            done.append((f"{folder}/{name}", *archive.close()))
        if done:
            columns = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["path", "n_bytes", "records"]
            )

    return write


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
    least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES, captured: str = CAPTURED,
) -> DataFrame:
    """Writes a record per row of ``pages``; ``(path, n_bytes, records)`` of the archives as a plan.

    The archives are written when the plan runs; store it once and read from the stored list.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload")
    ).select(
        "*",
        F.sha1("payload").alias("digest"),
        F.octet_length("payload").cast("long").alias("n_bytes"),
    )
    originals = scratch.store(
        rows.filter(F.col("n_bytes") >= least)
        .groupBy("digest", "n_bytes")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 and original is not null")
        .drop("copies"),
        "originals",
    )
    smaller = F.col("page_id").isNull() | (F.col("page_id") < F.col("original"))
    linked = rows.join(originals, ["digest", "n_bytes"], "left").withColumn(
        "refers_to", F.when(smaller, F.col("original"))
    )
    linked = linked.select(
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "digest",
        "n_bytes",
        "refers_to",
    )
    uri = qualified(pages.sparkSession, folder)
    return linked.mapInArrow(
        _writing(uri, archive_bytes, captured), "path string, n_bytes long, records long"
    )


# Reading


def directory(file, size: int, stored: tuple[str, ...] = ()) -> dict[str, tuple[int, int]]:
    """Offset and length of the data of each stored member of a ZIP file.

    Other members are left out; one whose name begins with any of ``stored`` is an error.
    """
    entries, n_bytes = _central(file, size)
    members, at = {}, 0
    while at + _ENTRY_SIZE <= n_bytes and entries[at : at + 4] == ENTRY:
        method, packed, plain, n_name, n_extra, n_comment, offset = struct.unpack(
            "<10xH8xIIHHH8xI", entries[at : at + _ENTRY_SIZE]
        )
        name_end = at + _ENTRY_SIZE + n_name
        name = entries[at + _ENTRY_SIZE : name_end].decode()
        wide = _zip64(entries[name_end : name_end + n_extra])
        plain = _wide(plain, wide)
        packed = _wide(packed, wide)
        offset = _wide(offset, wide)
        if method and name.startswith(stored) and stored:
            raise ValueError(f"{name} is compressed, and can only be read as a whole")
        if method == 0 and not name.endswith("/"):
            file.seek(offset)
            local = file.read(_LOCAL_SIZE)
            if local[:4] != LOCAL:
                raise ValueError(f"no member at {offset}")
            own_name, own_extra = struct.unpack("<26xHH", local)
            members[name] = (offset + _LOCAL_SIZE + own_name + own_extra, packed)
        at = name_end + n_extra + n_comment
    return members


def _central(file, size: int) -> tuple[bytes, int]:
    """The central directory, found from the end of the file."""
    tail = min(size, _END_SIZE + _FULL16 + _LOCATOR_SIZE)
    file.seek(size - tail)
    data = file.read(tail)
    end = data.rfind(END)
    if end < 0:
        raise ValueError("not a ZIP file")
    n_bytes, offset = struct.unpack("<12xII2x", data[end : end + _END_SIZE])
    locator = data[end - _LOCATOR_SIZE : end] if end >= _LOCATOR_SIZE else b""
    if locator[:4] == LOCATOR64:
        file.seek(struct.unpack("<8xQ4x", locator)[0])
        wide = file.read(56)
        if wide[:4] != END64:
            raise ValueError("no ZIP64 end record")
        n_bytes, offset = struct.unpack("<40xQQ", wide)
    file.seek(offset)
    return file.read(n_bytes), n_bytes


def _zip64(extra: bytes) -> list[int]:
    """The 64-bit values of an entry, in the order of the fields that are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[at : at + 4])
        if kind == 1:
            body = extra[at + 4 : at + 4 + n]
            return [struct.unpack("<Q", body[i : i + 8])[0] for i in range(0, n - n % 8, 8)]
        at += 4 + n
    return []


def _wide(value: int, wide: list[int]) -> int:
    return wide.pop(0) if value == _FULL32 and wide else value


_RUN = "path string, start long, lengths array<long>"
_RECORD = (
    "page_id long, url string, record_type string, refers_to long, declared_digest string, "
    "declared_bytes long, payload binary"
)
_RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("declared_digest", pa.string()),
        ("declared_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _indexing(run_bytes: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                paths, starts, lengths = [], [], []
                for start, run in _runs(path, run_bytes):
                    paths.append(path)
                    starts.append(start)
                    lengths.append(run)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(paths, pa.string()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.list_(pa.int64())),
                    ],
                    names=["path", "start", "lengths"],
                )

    return index


def _runs(path: str, run_bytes: int) -> Iterator[tuple[int, list[int]]]:
    """Where runs of neighbouring records start in the file, and how long each record is."""
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(name) as file:
        places = record_places(file, file.size())
    start, run, total = 0, [], 0
    for offset, length in places:
        if run and (total >= run_bytes or offset != start + total):
            yield start, run
            run, total = [], 0
        if not run:
            start = offset
        run.append(length)
        total += length
    if run:
        yield start, run


def record_places(file, size: int) -> list[tuple[int, int]]:
    """Where each record of a ZIP-packaged archive is, by all its indexes."""
    members = directory(file, size, stored=(ARCHIVE, INDEXES))
    data = {name.removeprefix(ARCHIVE): at for name, at in members.items() if name.startswith(ARCHIVE)}
    places, named = [], set()
    for index, (at, n_bytes) in members.items():
        if not index.startswith(INDEXES):
            continue
        file.seek(at)
        for line in file.read(n_bytes).decode().splitlines():
            offset, length, *rest = line.split(maxsplit=2)
            member = rest[0] if rest else _member_of(index, list(data))
            if member not in data:
                raise ValueError(f"{index} names {member}, which is not a member of {ARCHIVE}")
            start, member_bytes = data[member]
            if int(offset) + int(length) > member_bytes:
                raise ValueError(f"{index} has a record beyond the end of {member}")
            named.add(member)
            places.append((start + int(offset), int(length)))
    for member, (_, n_bytes) in data.items():
        if n_bytes and member not in named:
            raise ValueError(f"no index names the records of {member}")
    return places


def _member_of(index: str, members: list[str]) -> str | None:
    """The member that an index without names is of."""
    stem = index.removeprefix(INDEXES).partition(".")[0]
    own = members if len(members) == 1 else [m for m in members if m.partition(".")[0] == stem]
    return own[0] if len(own) == 1 else None


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, name = pafs.FileSystem.from_uri(row["path"])
            with fs.open_input_file(name) as file:
                file.seek(row["start"])
                data = file.read(sum(row["lengths"]))
            records, at = [], 0
            for length in row["lengths"]:
                records.append(parse(data[at : at + length]))
                at += length
            yield pa.RecordBatch.from_pylist(records, schema=_RECORD_ARROW)


def read_archives(archives: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """All records of the archives named by the column ``path``, of ``n_bytes`` each.

    ``(page_id, url, record_type, refers_to, declared_digest, declared_bytes, payload)``; a revisit has no
    payload of its own.
    """
    # The rows that name runs are small, so Spark cannot tell from them how much there is to read.
    total = archives.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    runs = archives.select("path").repartition(tasks, "path").mapInArrow(_indexing(run_bytes), _RUN)
    return runs.repartition(tasks, "path", "start").mapInArrow(_reading, _RECORD)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of pages written and read.

    Digest and length of a response are those of the payload that was read, and must agree with its
    headers; those of a revisit are what its headers say of the full payload.
    """
    scratch = Scratch(pages.sparkSession, "archives")
    plan = write_archives(pages, f"{scratch.folder}/files", **options)
    records = read_archives(scratch.store(plan, "archives"))
    read = F.struct(
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    declared = F.struct(
        F.col("declared_bytes").alias("payload_bytes"),
        F.col("declared_digest").alias("payload_digest"),
    )
    damaged = F.raise_error(F.concat(F.lit("damaged record of page "), F.col("page_id")))
    content = (
        F.when(F.col("record_type") == "revisit", declared)
        .when(read == declared, read)
        .otherwise(damaged)
    )
    return records.select(
        "page_id", content.alias("c"), "record_type", "refers_to"
    ).select("page_id", "c.payload_bytes", "c.payload_digest", "record_type", "refers_to")
