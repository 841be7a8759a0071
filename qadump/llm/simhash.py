"""SimHash near-dedup: fingerprints linked through the anchors of a covering code.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's shingles. Two
fingerprints are linked if they differ in `distance` (3) bits or fewer; groups are the
connected components.

Anchors. Of 3 differing bits, one half of the fingerprint holds 1 at most, so each half is
searched at threshold 1. The anchors of a half are the words of the perfect Hamming code
on 31 bits, with the last bit free: 2^27 anchors whose covering radius is 1. Every
fingerprint is sent to all anchors within radius plus threshold, 2 bits: 17 a half at
most, 34 in all. Its home is the anchor within 1 bit; a partner that differs in one
bit is within 2 bits of that home, so each linked pair meets at a home of either one. (One
covering code over all 64 bits at threshold 3 would need over a thousand copies of each
fingerprint for as many anchors.)

Work is done on distinct fingerprints, so copies cost nothing. At each anchor fingerprints are
compared by XOR and bit count in numpy, and only a spanning forest of the links is returned.
Anchors with more than `block` fingerprints are dealt out as pairs of blocks, so that no
task holds more than two blocks of one anchor; no pair is left out.

Rows meet their group's name by a join on the fingerprint, and links their roots by joins on it; a
fingerprint with a third of all rows (empty texts, a page with many copies) is left to Spark's adaptive
skew join there, which splits the side that has its rows.

Null and empty texts, and those of white space, have fingerprint 0 and are linked as any
other; a bit set in exactly half of the hashes counts as not set; very long texts are read in blocks, with
shingles over the seams; null ids get a fingerprint but never name a group; repeated rows share a group; an
empty table gives an empty result. Only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qadump.llm import components
from qadump.llm.common import blocks, staged

SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    digest, ones, total, words = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), 0, []
    for block in blocks(text or ""):
        # Bytes: of them only A-Z and ASCII white space count. Shingles go on over the seam.
        words = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
        words += block.encode("utf-8").lower().split()
        if len(words) < shingle:
            continue
        hashes = _hashes(words, shingle, digest)
        ones += _ones(hashes)
        total += len(hashes)
    if not total and words:  # fewer words than a shingle has
        ones, total = _ones(np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)), 1
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _hashes(words: list[bytes], shingle: int, digest: Callable[[bytes, int], int]) -> np.ndarray:
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    spans = zip((ends - sizes)[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64)


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the highest first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(
    docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row."""

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), _fingerprint(text, shingle).alias("fp"))


def _fingerprint(text: str, shingle: int) -> Column:
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = (fingerprint(t.as_py(), shingle) for t in texts)
        return pa.array(np.fromiter(found, dtype=np.uint64, count=len(texts)).view(np.int64))

    return of(F.col(text))


# The code of a half: 31 bits at positions 1 .. 31, whose positions' XOR is 0 in a code word.
_POSITIONS = np.zeros((4, 256), dtype=np.uint32)
for _byte in range(4):
    for _value in range(256):
        for _bit in range(8):
            if _value >> _bit & 1 and 8 * _byte + _bit < 31:
                _POSITIONS[_byte, _value] ^= 8 * _byte + _bit + 1
#: For each syndrome the 15 pairs of positions whose XOR it is, as masks.
_PAIRS = np.zeros((32, 15), dtype=np.uint32)
for _syndrome in range(1, 32):
    _PAIRS[_syndrome] = [
        (1 << i - 1) | (1 << (i ^ _syndrome) - 1)
        for i in range(1, 32)
        if i < i ^ _syndrome and i != _syndrome
    ]


def homes(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest anchor of each 32-bit half, and its syndrome."""
    syndrome = np.zeros(len(half), dtype=np.uint32)
    for byte in range(4):
        syndrome ^= _POSITIONS[byte][(half >> np.uint32(8 * byte)) & np.uint32(255)]
    flip = np.where(syndrome > 0, np.uint32(1) << (np.maximum(syndrome, 1) - 1).astype(np.uint32), 0)
    return half ^ flip.astype(np.uint32), syndrome


def halves(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unsigned = fps.view(np.uint64)
    return (unsigned >> np.uint64(32)).astype(np.uint32), unsigned.astype(np.uint32)


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (anchor, row) within radius plus threshold, as arrays; the side is the anchor's bit 32."""
    keys, rows = [], []
    for side, half in enumerate(halves(fps)):
        home, syndrome = homes(half)
        everyone = np.arange(len(fps))
        own = [(home, everyone), (home ^ np.uint32(1 << 31), everyone)]
        off = np.flatnonzero(syndrome)  # a code word has no other within 2 bits
        own += [(half[off] ^ _PAIRS[syndrome[off], k], off) for k in range(15)]
        for anchor, row in own:
            keys.append(anchor.astype(np.int64) | side << 32)
            rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _replicas(distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            keys, rows = anchors(fps)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], names=["anchor", "fp"])

    return distinct.select("fp").mapInArrow(run, "anchor long, fp long")


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is linked among fps, one fewer than the members of each group."""
    left, links = fps.copy(), []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            near = np.bitwise_count(left ^ one) <= distance
            if near.any():
                links += [(int(one), int(other)) for other in left[near]]
                front += list(left[near])
                left = left[~near]
    return links


def _compare(key: np.ndarray, anchor: np.ndarray, fps: np.ndarray, distance: int) -> np.ndarray:
    """Links among rows of equal keys; rows are sorted by key, and groups are whole."""
    edges = [np.empty((0, 2), dtype=np.int64)]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[first, len(key)])
    unsigned = fps.view(np.uint64)
    large = sizes > 8
    for start, size in zip(first[large].tolist(), sizes[large].tolist(), strict=True):
        links = _forest(unsigned[start : start + size], distance)
        if links:
            edges.append(np.array(links, dtype=np.uint64).view(np.int64))
    member = np.repeat(np.where(large | (sizes < 2), -1, np.arange(len(first))), sizes)
    high, low = halves(fps)
    half = np.where(anchor >> 32 == 0, high, low)
    is_home = homes(half)[0] == anchor.astype(np.uint32)
    small = np.flatnonzero(member >= 0)
    member, is_home, unsigned = member[small], is_home[small], unsigned[small]
    for step in range(1, 8):
        together = np.flatnonzero(member[step:] == member[:-step]) if len(member) > step else []
        if not len(together):
            break
        met = together[is_home[together] | is_home[together + step]]
        near = met[np.bitwise_count(unsigned[met] ^ unsigned[met + step]) <= distance]
        edges.append(np.stack([unsigned[near], unsigned[near + step]], axis=1).view(np.int64))
    return np.unique(np.concatenate(edges), axis=0)


def links(distinct: DataFrame, distance: int = 3, block: int = 4_096) -> DataFrame:
    """a, b: enough links between the distinct fingerprints of column fp to connect each group."""
    if not 0 <= distance <= 3:
        raise ValueError("the anchors cover distances up to 3")
    replicas = _replicas(distinct)
    crowded = staged(
        replicas.groupBy("anchor")
        .count()
        .where(F.col("count") > block)
        .select("anchor", F.ceil(F.col("count") / block).cast("int").alias("blocks")),
        "crowded",
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")),
    )
    one_block = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    met = (
        replicas.join(crowded, "anchor", "left")
        .withColumn("pair", F.explode(F.when(F.col("blocks").isNull(), one_block).otherwise(pairs)))
        .select("anchor", "pair.i", "pair.j", "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 4), dtype=np.int64)

        def found(rows: np.ndarray) -> pa.RecordBatch:
            rows = np.ascontiguousarray(rows)
            edges = _compare(rows[:, :3], rows[:, 0], np.ascontiguousarray(rows[:, 3]), distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(edges[:, k])) for k in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            new = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)], axis=1)
            held = np.concatenate([held, new])
            # The last group may go on in the next batch.
            last = np.flatnonzero((held[:, :3] != held[-1, :3]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield found(held[:cut])
                held = held[cut:]
        if len(held):
            yield found(held)

    group = ["anchor", "i", "j"]
    return met.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "a long, b long").distinct()


def groups(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, fp and component_id (the smallest id of the group) of every row."""
    rows = staged(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    return rows.join(named(rows, distance), "fp").select("doc_id", "fp", "component_id")


def named(rows: DataFrame, distance: int = 3) -> DataFrame:
    """fp and component_id of every distinct fp of rows, which hold doc_id and fp."""
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    root = components.roots(links(distinct, distance))
    rooted = distinct.join(root, distinct.fp == root.vertex, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("fp", "component_id")


def hexadecimal(fp: str) -> Column:
    """The fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def deduplicated(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row of each group, that of the smallest id, with the columns of docs.

    Rows of one id are told apart by a number that is fixed when the rows are staged.
    """

    rows = staged(
        docs.select(
            F.struct("*").alias("row"),
            F.col(doc_id).cast("long").alias("doc_id"),
            _fingerprint(text, shingle).alias("fp"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "dedup",
    )
    slim = rows.select("uid", "doc_id", "fp")
    # Ids sort before null ones, and rows of one id by their number.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    best = slim.groupBy("fp").agg(first.alias("best"))
    distinct = staged(best, "best")
    root = components.roots(links(distinct, distance))
    kept = (
        distinct.join(root, distinct.fp == root.vertex, "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.uid").alias("uid"))
    )
    return rows.join(kept, "uid", "left_semi").select("row.*")
