"""WARC records in ZIP packages: written by tasks, read back by byte ranges.

A package is a ZIP file with two stored members, the records and an index of them:
``archive/data.warc`` and ``indexes/index.cdx`` (one line a record: offset, length). A task writes
its packages to the shared folder under names of its own and returns their paths; only paths of
tasks that succeeded are written to the manifest, so a repeated or lost task leaves nothing
that is read.

The reader never extracts: it takes the central directory from a package's end (the ZIP64 one where
there is one), finds where the stored members begin, reads the index, deals byte ranges of
records out over tasks, and each task reads its ranges only.
"""

import hashlib
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.sources.scratch import materialise, scratch_path

DATA, INDEX = "archive/data.warc", "indexes/index.cdx"
_ID = re.compile(rb"<urn:x-page:(-?\d+)>")
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, payload binary"
)


def write_archives(
    pages: DataFrame,
    root: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 100,
    archive_bytes: int = 64 << 20,
) -> DataFrame:
    """Write a record per row into packages under ``root``; returns their manifest.

    Of the rows with equal payloads of at least ``least_bytes`` bytes, the one with the smallest id is
    a response and the others are revisits of it, which hold no payload; smaller payloads are
    all responses. Rows that repeat the smallest id are responses too.

    A null payload is empty. A row with a null id is a response that no other refers to. A null url
    is left out of its record. Other columns are not read. An empty table writes no package.
    """
    root = root or scratch_path(pages.sparkSession, "archives")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    base = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    thin = base.where(F.octet_length("payload") >= least_bytes).where("id is not null")
    thin = thin.select("id", "digest")
    firsts = (
        thin.groupBy("digest")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last")
        .select("digest", "first")
    )
    # Thin rows only: a payload that very many pages have is split by the join itself.
    revisits = materialise(
        thin.join(firsts, "digest").where("id > first").select("id", "digest", "first").distinct(),
        "revisits",
    )
    marked = base.join(revisits, ["id", "digest"], "left").select(
        "id", "url", "payload", "digest", "first"
    )
    write = partial(_write, root=root, archive_bytes=archive_bytes)
    return materialise(marked.mapInArrow(write, "path string, records long"), "manifest")


def read_archives(manifest: DataFrame, range_bytes: int = 8 << 20) -> DataFrame:
    """All records of the packages in ``manifest`` (a column ``path``).

    ``payload_digest`` and ``payload_bytes`` are those of the full payload, for revisits too, whose
    ``payload`` is null. A response whose payload does not have its digest fails the job.
    """
    ranges = materialise(
        manifest.select("path").mapInArrow(
            partial(_ranges, range_bytes=range_bytes),
            "path string, start long, length long, records long",
        ),
        "ranges",
    )
    # A number of its own, or the few bytes that name the ranges would end up in one task.
    tasks = max(1, min(ranges.count(), 20_000))
    return ranges.repartition(tasks).mapInArrow(_read, RECORD)


def _open(path: str):
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def _record(id_, url, payload: bytes, digest: str, first) -> bytes:
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    body = http if first is not None else http + payload
    kind = "response" if first is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 2000-01-01T00:00:00Z"]
    name = uuid.uuid4().urn if id_ is None else f"urn:x-page:{id_}"
    lines.append(f"WARC-Record-ID: <{name}>")
    if url is not None:
        safe = "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    if first is not None:
        lines.append(f"WARC-Refers-To: <urn:x-page:{first}>")
        lines.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _write(batches: Iterator[pa.RecordBatch], root: str, archive_bytes: int):
    files, folder = _open(root)
    files.create_dir(folder, recursive=True)
    package, index, offset = None, [], 0

    def close():
        package[2].close()
        package[1].writestr(INDEX, "".join(f"{a} {n}\n" for a, n in index))
        package[1].close()
        package[0].close()
        return pa.RecordBatch.from_pydict({"path": [package[3]], "records": [len(index)]})

    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
            if package is None:
                name = f"part-{uuid.uuid4().hex}.zip"
                stream = files.open_output_stream(f"{folder}/{name}")
                pack = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                data = pack.open(DATA, "w", force_zip64=True)
                package, index, offset = (stream, pack, data, f"{root}/{name}"), [], 0
            record = _record(*row)
            package[2].write(record)
            index.append((offset, len(record)))
            offset += len(record)
            if offset >= archive_bytes:
                yield close()
                package = None
    if package is not None:
        yield close()


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """Stored members of a ZIP file: name -> (first byte, length). ``file.read_at(n, at)``."""
    tail = file.read_at(min(size, 65_557), max(0, size - 65_557))
    at = tail.rfind(b"PK\x05\x06")
    # A comment may hold the mark as well: the record's own comment has to end where the file does.
    while at >= 0 and not _ends_file(tail, at):
        at = tail.rfind(b"PK\x05\x06", 0, at + 3)
    if at < 0:
        raise ValueError("no end of a central directory")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    place = size - len(tail) + at
    if place >= 20 and (entries == 0xFFFF or 0xFFFFFFFF in (length, start)):
        mark, _, far = struct.unpack_from("<4sIQ", file.read_at(20, place - 20))
        if mark == b"PK\x06\x07":
            end = file.read_at(56, far)
            if end[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of a central directory")
            entries, length, start = struct.unpack_from("<QQQ", end, 32)
    directory = file.read_at(length, start)
    found, at = {}, 0
    for _ in range(entries):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        packed, header = _zip64(extra, packed, plain, header)
        if method == zipfile.ZIP_STORED:
            own = struct.unpack_from("<HH", file.read_at(30, header), 26)
            found[name] = (header + 30 + sum(own), packed)
        at += 46 + n_name + n_extra + n_note
    return found


def _ends_file(tail: bytes, at: int) -> bool:
    if at + 22 > len(tail):
        return False
    return at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)


def _zip64(extra: bytes, packed: int, plain: int, header: int) -> tuple[int, int]:
    """Sizes and places that do not fit 32 bits stand in an extra field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            plain = next(values) if plain == 0xFFFFFFFF else plain
            packed = next(values) if packed == 0xFFFFFFFF else packed
            header = next(values) if header == 0xFFFFFFFF else header
        at += 4 + n
    return packed, header


def _ranges(batches: Iterator[pa.RecordBatch], range_bytes: int):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            files, name = _open(path)
            size = files.get_file_info(name).size
            with files.open_input_file(name) as file:
                found = members(file, size)
                first, _ = found[DATA]
                at, n = found[INDEX]
                lines = file.read_at(n, at).split(b"\n")[:-1]
            out: list[list[int]] = []
            for line in lines:
                offset, length = map(int, line.split())
                if not out or out[-1][1] + length > range_bytes:
                    out.append([first + offset, 0, 0])
                out[-1][1] += length
                out[-1][2] += 1
            if out:
                start, length, records = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": [path] * len(out),
                        "start": start,
                        "length": length,
                        "records": records,
                    }
                )


def _parse(data: memoryview, at: int) -> tuple[tuple, int]:
    """The record that begins at ``at``, and where the next one does."""
    raw = bytes(data[at : at + 16384])
    end = raw.find(b"\r\n\r\n")
    while end < 0 and at + len(raw) < len(data):
        raw = bytes(data[at : at + 2 * len(raw)])
        end = raw.find(b"\r\n\r\n")
    lines = raw[:end].split(b"\r\n")
    if lines[0] != b"WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(line.split(b": ", 1) for line in lines[1:])
    begin = at + end + 4
    stop = begin + int(head[b"Content-Length"])
    body = bytes(data[begin:stop])
    if bytes(data[stop : stop + 4]) != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where it says")
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    kind = head[b"WARC-Type"].decode()
    digest = head[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("a payload does not have its digest")
    id_ = _ID.fullmatch(head[b"WARC-Record-ID"])
    other = _ID.fullmatch(head.get(b"WARC-Refers-To", b""))
    url = head.get(b"WARC-Target-URI")
    row = (
        int(id_[1]) if id_ else None,
        url.decode() if url is not None else None,
        kind,
        int(other[1]) if other else None,
        digest,
        size,
        payload if kind == "response" else None,
    )
    return row, stop + 4


def _read(batches: Iterator[pa.RecordBatch]):
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [
        pa.int64(),
        pa.string(),
        pa.string(),
        pa.int64(),
        pa.string(),
        pa.int64(),
        pa.binary(),
    ]
    for batch in batches:
        for path, start, length, records in zip(
            *[batch.column(i).to_pylist() for i in range(4)], strict=True
        ):
            files, name = _open(path)
            with files.open_input_file(name) as file:
                data = memoryview(file.read_at(length, start))
            rows, at = [], 0
            for _ in range(records):
                row, at = _parse(data, at)
                rows.append(row)
            columns = [
                pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
