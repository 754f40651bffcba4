"""WARC in ZIP: round trip, revisits, ZIP64 and broken files."""

import base64
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from revlens.llm import warczip as Z
from revlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def want(rows, least=0):
    top = {}
    for i, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= least:
            top[b] = max(i, top.get(b, i))
    out = []
    for i, h in rows:
        b = (h or "").encode()
        big = top.get(b)
        rev = big is not None and i != big
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if rev else "response", big if rev else None))
    return sorted(out, key=str)


def test_query_matches_definition(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    got = QUERIES["op9_warc"][0](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == want(rows)


@pytest.mark.parametrize("least", [0, 4])
def test_edge_rows(spark, least):
    rows = [(1, "same\r\n\r\n"), (5, "same\r\n\r\n"), (3, "same\r\n\r\n"), (2, None), (8, ""), (9, "é" * 50_000),
            (7, "abc"), (6, "abc"), (None, "abc"), (None, "lone"), (4, "z"), (4, "z")]
    df = spark.createDataFrame([(i, "http://h/\n" if i != 2 else None, h, "x") for i, h in rows],
                               "page_id bigint, url string, html string, payload string")
    folder = Z.scratch_path(spark, "warc-test")
    manifest = Z.write_archives(df, folder, least, archive_bytes=64)
    assert manifest.count() > 1
    got = Z.read_archives(manifest, with_payload=True, span_bytes=100, folder=folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                  key=str) == want(rows, least)
    texts = {(i, (h or "").encode()) for i, h in rows}
    assert all((r.page_id, bytes(r.payload)) in texts for r in got if r.record_type == "response")
    assert {r.url for r in got} == {None, "http://h/%0A"}
    empty = Z.write_archives(df.limit(0), Z.scratch_path(spark, "warc-test"))
    assert Z.read_archives(empty).count() == 0


def test_zip64_directory_and_comment():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        with z.open("a/b", "w", force_zip64=True) as m:
            m.write(b"first")
        z.writestr("c", b"second" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 looks like an end record"
    data = buf.getvalue()
    f = pa.BufferReader(data)
    reader = type("R", (), {"read_at": staticmethod(lambda n, at: (f.seek(at), f.read(n))[1])})
    got = Z.zip_members(reader, len(data))
    assert set(got) == {"a/b", "c"} and got["a/b"][1:] == (5, 0) and got["c"][2] == zipfile.ZIP_DEFLATED
    assert data[got["a/b"][0]:got["a/b"][0] + 5] == b"first"
    with pytest.raises(ValueError):
        Z.zip_members(reader, len(data) - 30)


def test_zip64_end_record(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 20)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for i in range(4):
            z.writestr(f"m{i}", b"0123456789" * 5)
    data = buf.getvalue()
    assert Z.END64 in data
    reader = type("R", (), {"read_at": staticmethod(lambda n, at: data[at:at + n])})
    got = Z.zip_members(reader, len(data))
    assert [data[o:o + n] for o, n, _ in got.values()] == [b"0123456789" * 5] * 4


def test_changed_payload_is_refused():
    import zlib
    rec = Z.make_record(1, "u", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(),
                        None, False, "2024-01-01T00:00:00Z")
    raw = zlib.decompress(rec, 31)
    assert Z.parse_record(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        Z.parse_record(raw.replace(b"payload\r\n", b"pAyload\r\n"))
