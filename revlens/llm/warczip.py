"""WARC archives packaged in ZIP files, read by byte ranges.

Writing: every task writes ZIP files into a shared folder, each with one
stored member of WARC records (every record its own gzip member), one
stored index member (offset and length of each record) and a description.
File names are unique to the attempt; only the files that a finished task
reports in the manifest are ever read, so a lost executor or a speculative
copy leaves at most unused files.

Reading: the end record, the ZIP64 locator and end record, the central
directory and the local headers are parsed from byte ranges; index lines
become spans of neighbouring records, spans are dealt to tasks, and each
task reads its spans from the archive in place.  Nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

RECORDS, INDEX, ABOUT = "archive/data.warc.gz", "indexes/index.cdx", "datapackage.json"
#: A task starts a new ZIP file after so many bytes; spans to read hold about so many.
ARCHIVE_BYTES = 256 << 20
SPAN_BYTES = 4 << 20
#: Bytes of archives that one partition of the readers stands for at most, on
#: average; below that, there are two partitions for each core.
READ_BYTES = 256 << 20
# Fixed values of the formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
CENTRAL, LOCAL = b"PK\x01\x02", b"PK\x03\x04"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (or an absolute path) in shared storage."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


# --- records -----------------------------------------------------------------

def page_urn(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    return int(v) if (v := urn.removeprefix("<urn:x-page:").rstrip(">")) else None


def _field(value: str) -> str:
    """A header value on one line (percent-encoded controls)."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def make_record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool, date: str) -> bytes:
    """One gzip member with one WARC record."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
            f"WARC-Record-ID: {page_urn(page_id)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    if is_revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {page_urn(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse_record(raw: bytes) -> dict:
    """Fields and payload of one record; the payload of a response must have
    the digest that its header states."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
    return {"page_id": _page_of(h["warc-record-id"]), "url": h.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": digest, "record_type": h["warc-type"],
            "refers_to": _page_of(h["warc-refers-to"]) if "warc-refers-to" in h else None,
            "payload": payload if h["warc-type"] == "response" else None}


# --- ZIP directory -------------------------------------------------------------

def zip_members(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (offset of the member's bytes, stored size, method), from the
    central directory (ZIP64 too) of an open file with ``read_at``."""
    tail_at = max(0, size - (22 + 65535))
    tail = f.read_at(size - tail_at, tail_at)
    at = tail.rfind(END, 0, max(0, len(tail) - 18))  # the record has 22 bytes
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(END, 0, at)  # the signature may stand in the comment
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = f.read_at(20, tail_at + at - 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end64 = f.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, found, p = f.read_at(length, start), {}, 0
    for _ in range(count):
        if directory[p:p + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", directory, p + 10)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, p + 20)
        offset, = struct.unpack_from("<I", directory, p + 42)
        name = directory[p + 46:p + 46 + n_name].decode()
        extra, e = directory[p + 46 + n_name:p + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, e)
            if tag == 1:  # ZIP64 sizes, in the order of the fields they replace
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, e + 4))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            e += 4 + n
        local = f.read_at(30, offset)
        if local[:4] != LOCAL:
            raise ValueError("broken local header")
        found[name] = (offset + 30 + sum(struct.unpack_from("<HH", local, 26)), packed, method)
        p += 46 + n_name + n_extra + n_note
    return found


# --- Spark ---------------------------------------------------------------------

def assign_types(pages: DataFrame, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``page_id, url, payload, sha1, largest``: ``largest`` is the largest id
    among equal payloads of at least ``min_revisit_bytes`` (null if smaller)."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       payload.alias("payload")).withColumn("sha1", F.unhex(F.sha1("payload")))
    # payloads that stand alone need no partner: only groups of copies are joined
    groups = (src.where(F.octet_length("payload") >= min_revisit_bytes).groupBy(F.col("sha1").alias("of"))
                 .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("largest")).where("n > 1"))
    return src.join(groups, src.sha1 == groups["of"], "left").select("page_id", "url", "payload", "sha1", "largest")


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES, **columns: str) -> DataFrame:
    """Write a record per row into ZIP files under ``folder`` and return the
    manifest (``path, size, records``), itself stored, so that reading it
    never writes again.

    A null html is an empty payload.  Of equal payloads the row with the
    largest id is the response, the others revisit it; rows that repeat that
    id are responses too, and a group whose ids are all null has responses
    only.  An empty table writes no archive."""
    rows = assign_types(pages, min_revisit_bytes, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        out, index, done = None, [], []

        def close() -> None:
            nonlocal out
            raw, z, member, path, pos = out
            member.close()
            with z.open(INDEX, "w", force_zip64=True) as m:
                m.write("".join(index).encode())
            with z.open(ABOUT, "w") as m:
                m.write(json.dumps({"profile": "data-package", "resources": [
                    {"name": "records", "path": RECORDS, "bytes": pos}, {"name": "index", "path": INDEX}]}).encode())
            z.close()
            raw.close()
            done.append((path, fs.get_file_info(path).size, len(index)))
            index.clear()
            out = None

        for b in batches:
            for pid, url, payload, sha1, largest in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    path = f"{root.rstrip('/')}/part-{uuid.uuid4().hex}.wacz"
                    raw = fs.open_output_stream(path)
                    z = zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED)
                    out = [raw, z, z.open(RECORDS, "w", force_zip64=True), path, 0]
                revisit = largest is not None and pid != largest
                rec = make_record(pid, url, payload, base64.b32encode(sha1).decode(),
                                  largest if revisit else None, revisit, date)
                out[2].write(rec)
                index.append(f"{out[4]} {len(rec)}\n")
                out[4] += len(rec)
                if out[4] >= archive_bytes:
                    close()
        if out is not None:
            close()
        cols = list(zip(*done)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.int64())], names=["path", "size", "records"])

    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    return materialize(rows.mapInArrow(run, "path string, size bigint, records bigint"), "manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False, span_bytes: int = SPAN_BYTES,
                  folder: str | None = None) -> DataFrame:
    """Records of the ZIP files in ``manifest`` (``path``): ``page_id, url,
    payload_bytes, payload_digest, record_type, refers_to`` (and ``payload``,
    null for revisits).  ``folder`` names the storage the paths are in."""
    store = folder or "/"

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(store)
        for b in batches:
            for path in b.column(0).to_pylist():
                out = []
                with fs.open_input_file(path) as f:
                    members = zip_members(f, f.size())
                    (base, _, m1), (at, size, m2) = members[RECORDS], members[INDEX]
                    if m1 or m2:
                        raise ValueError(f"{path}: members must be stored to be read in place")
                    end, rest, lo, hi = at + size, b"", 0, 0
                    while at < end:  # the index itself is read in ranges
                        rest += f.read_at(min(1 << 20, end - at), at)
                        at = min(end, at + (1 << 20))
                        lines = rest.split(b"\n")
                        rest = lines.pop()
                        for line in lines:
                            offset, length = map(int, line.split())
                            if hi > lo and hi - lo + length > span_bytes:
                                out.append((path, base + lo, hi - lo))
                                lo = offset
                            hi = offset + length
                    if hi > lo:
                        out.append((path, base + lo, hi - lo))
                p, s, n = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.string()), pa.array(s, pa.int64()),
                                                  pa.array(n, pa.int64())], names=["path", "start", "length"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(store)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        if not with_payload:
            names, kinds = names[:-1], kinds[:-1]
        for b in batches:
            for path, start, length in zip(*(c.to_pylist() for c in b.columns)):
                with fs.open_input_file(path) as f:
                    raw = f.read_at(length, start)
                found = []
                while raw:
                    z = zlib.decompressobj(31)
                    found.append(parse_record(z.decompress(raw)))
                    raw = z.unused_data
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in zip(names, kinds)],
                                                 names=names)

    schema = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
              "refers_to bigint" + ", payload binary" * with_payload)
    # rows that name archives and spans are small whatever they name: partitions by the bytes behind them, in a number
    # that adaptive execution doesn't merge
    files, size = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = 2 * manifest.sparkSession.sparkContext.defaultParallelism

    def parts(most: int) -> int:
        return max(1, min(most, tasks), -(-size // READ_BYTES))

    found = (manifest.select("path").repartition(parts(files), "path")
                     .mapInArrow(spans, "path string, start bigint, length bigint"))
    return found.repartition(parts(-(-size // span_bytes)), "path", "start").mapInArrow(records, schema)


def round_trip(spark: SparkSession, pages: DataFrame, min_revisit_bytes: int = 0, with_payload: bool = False,
               **columns: str) -> DataFrame:
    """Write the archives of ``pages`` into the shared folder and read them back."""
    folder = scratch_path(spark, "warc")
    manifest = write_archives(pages, folder, min_revisit_bytes, **columns)
    return read_archives(manifest, with_payload, folder=folder)
