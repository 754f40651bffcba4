"""Sequence packing by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are powers of two
(whole sequences of the full length first, then the binary digits of the
rest, descending).  Each piece is a sequence of its own and sequences of one
length form a bucket, so no sequence crosses documents and none needs
padding.  The bucket of a sequence is the top of its ``sequence_id``: sorted
ids are sorted by bucket.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a sequence id below its bucket.
BUCKET_SHIFT = 58


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> tiktoken.Encoding:
    """Encoder of a byte-level BPE ``tokenizer.json`` whose ids follow the
    merge order (checked); its special tokens are matched first."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    back = byte_alphabet()
    ranks = {bytes(back[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
    if any(spec["model"]["vocab"][m] != 256 + i for i, m in enumerate(merged)):
        raise ValueError("the ids of this vocabulary do not follow its merge order")
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def pieces_of(n: int, full: int) -> list[tuple[int, int]]:
    """(start, length) pieces of ``n`` tokens: powers of two up to ``full``."""
    out = [(s, full) for s in range(0, n - full + 1, full)]
    at, rest = n - n % full, n % full
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, bucket`` (and the ids themselves ``with_ids``).

    A null or empty text is the end id alone; rows that repeat are packed
    each on its own; ``length`` is a power of two, which bounds every piece.
    Tokens are made where the text is read: nothing is shuffled."""
    if length & (length - 1) or length < 1:
        raise ValueError("length must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = byte_bpe(tokenizer_path)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                owner, rows, ids = [], [], []
                for k, text in enumerate(part.column("text").to_pylist()):
                    toks = enc.encode_to_numpy(text or "", allowed_special="all").astype("<u4", copy=False)
                    toks = np.append(toks, np.uint32(end_id))
                    n = len(toks)
                    for s, size in pieces_of(n, length):
                        piece = toks[s:s + size]
                        owner.append(k)
                        rows.append((s, size, zlib.crc32(piece.tobytes()), n, size.bit_length() - 1))
                        if with_ids:
                            ids.append(piece.astype(np.int64))
                cols = np.array(rows, np.int64).reshape(-1, 5).T
                arrays = [part.column("doc_id").take(pa.array(owner, pa.int32())),
                          *(pa.array(c) for c in cols[:4]), pa.array(cols[4].astype(np.int32))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket"]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, bucket int"
              + ", ids array<bigint>" * with_ids)
    pieces = src.mapInArrow(run, schema)
    seq = F.shiftleft(F.col("bucket").cast("bigint"), BUCKET_SHIFT) + F.monotonically_increasing_id()
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", seq.alias("sequence_id"),
                         F.lit(0).cast("bigint").alias("offset"), "bucket", *(["ids"] if with_ids else []))
