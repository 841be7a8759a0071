"""Packing: power-of-two decomposition of token documents.

A document's tokens are cut into pieces whose lengths are powers of two, the longest
first: as many of `max_tokens` as fit, then the binary digits of the rest. Every piece is
a sequence of its own, so no sequence crosses documents and none is padded. Pieces of one
length form a bucket, named by that length in `bucket`, and a batch is drawn from one bucket;
`write_buckets` lays pieces out that way, one folder a bucket.

Cutting is local to a document: there is no shuffle, and no document or bucket is gathered.

A null text is an empty one: one piece that holds the end id alone. Repeated rows are packed
each for itself, null ids are kept, an empty table gives no pieces. Only the id and text
columns are read, so other columns can't clash. Very long texts are tokenised in blocks.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from qadump.llm.common import small_batches

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"
)
#: Characters of a block of a very long text.
BLOCK = 1_000_000
#: A single blank between two characters that are no white space: no token crosses its left edge.
SEAM = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Texts of these characters alone go to the faster of two readers of the same vocabulary.
PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ɏ‐-‧€]*\Z")
SPECIAL = "<|"


@lru_cache(maxsize=4)
def _readers(vocabulary: str) -> tuple[tiktoken.Encoding, Tokenizer]:
    """The tokenizer, and its merges as byte-pair ranks, which is several times faster."""
    exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    exact.no_truncation()
    exact.no_padding()
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return fast, exact


def _blocks(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > BLOCK:
        seam = SEAM.search(text, start + BLOCK)
        if not seam:
            break
        yield text[start : seam.start()]
        start = seam.start()
    yield text[start:]


def token_ids(text: str, vocabulary: str = "byte_bpe_50k") -> np.ndarray:
    """The ids that the tokenizer gives for the whole text."""
    fast, exact = _readers(vocabulary)
    parts = []
    for block in _blocks(text):
        if SPECIAL not in block and PLAIN.match(block):
            parts.append(fast.encode_ordinary(block))
        else:
            parts.append(exact.encode(block, add_special_tokens=False).ids)
    return np.concatenate([np.array(p, dtype=np.uint32) for p in parts])


def piece_lengths(tokens: int, max_tokens: int) -> list[int]:
    """Powers of two that sum to `tokens`, none above `max_tokens`, the longest first."""
    lengths = [max_tokens] * (tokens // max_tokens)
    rest = tokens % max_tokens
    return lengths + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def pack(
    docs: DataFrame,
    max_tokens: int = 1024,
    end_id: int = 0,
    vocabulary: str = "byte_bpe_50k",
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, ids."""
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows: list[list] = [[], [], [], [], [], []]
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(token_ids(body or "", vocabulary), np.uint32(end_id))
                start = 0
                for length in piece_lengths(len(ids), max_tokens):
                    piece = ids[start : start + length]
                    crc = zlib.crc32(piece.astype("<u4").tobytes())
                    values = (key, start, length, crc, len(ids), piece if with_ids else None)
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
                    start += length
            types = [pa.int64()] * 5 + [pa.list_(pa.int32())]
            columns = [pa.array(c, type=t) for c, t in zip(rows, types, strict=True)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = columns.mapInArrow(cut, PIECES)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.col("length").cast("int").alias("bucket"),
        *(["ids"] if with_ids else []),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The result of `pack` as Parquet, one folder per bucket, each read without the others."""
    pieces.write.partitionBy("bucket").parquet(path)
