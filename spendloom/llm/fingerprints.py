"""SimHash document fingerprints and the search for near ones.

A document's terms are its word pairs (a single word: the word); a term found
n times weighs 1 + floor(log2 n). Every term hash votes on each of BITS signed bits;
the fingerprint is the signs. The angle between two documents' term vectors is
about pi * (bits that differ) / BITS, so the likeness is the cosine of that,
0 at least.

Near fingerprints: two fingerprints within `radius` bits agree on at least one
of `radius + 1` blocks. There is one table per block, the fingerprints keyed
by that block (the block permuted to the front); equal keys are compared
exactly. Equal fingerprints are compared once, as one class. Texts of a likeness
of 0.8 are NEAR_BITS bits apart, where no block is long enough to be worth a
table: there the fingerprints asked for are compared with all others, 32 bytes each.

Defined results: null text is empty; a text without words has the fingerprint
of all zero bits, and two such texts have likeness 1. Repeated rows get equal
fingerprints and are counted each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import MASK, mix64, saved, shingle_hashes, utf8, word_hashes
from spendloom.llm.neighbours import with_next

LANES = 4  # 64-bit words of a fingerprint
BITS = 64 * LANES
SHINGLE = 2

_SHIFTS = np.arange(8, dtype=np.uint64)[:, None, None]
_LOW_BITS = np.uint64(0x0101010101010101)
_LANE_SALTS = np.array([0x9E3779B97F4A7C15 * (i + 1) & MASK for i in range(LANES)], np.uint64)[:, None]


def _weighted(terms: np.ndarray) -> np.ndarray:
    """Distinct terms, one found n times listed 1 + floor(log2 n) times."""
    terms, counts = np.unique(terms, return_counts=True)
    return terms if counts.max() == 1 else np.repeat(terms, np.frexp(counts)[1])


def fingerprint(words: np.ndarray, shingle: int = SHINGLE) -> bytes:
    """SimHash of a document given the 64-bit hashes of its words."""
    if not len(words):
        return bytes(BITS // 8)
    terms = _weighted(shingle_hashes(words, shingle))
    lanes = mix64(terms[None, :] + _LANE_SALTS)
    # Eight byte-wide counters ride in one 64-bit word; 255 rows cannot overflow them.
    ones = np.zeros((8, LANES, 8), np.int64)
    for at in range(0, lanes.shape[1], 255):
        part = ((lanes[None, :, at : at + 255] >> _SHIFTS) & _LOW_BITS).sum(axis=2)
        ones += part.view(np.uint8).reshape(8, LANES, 8)
    return np.packbits((2 * ones > len(terms)).ravel()).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    differ = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
    return max(0.0, float(np.cos(np.pi * differ / BITS)))


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likenesses.

    `docs` has (doc_id long, text string). The edited text has its last
    floor(n/2) code points replaced by the first as many (or all) of the next
    document in descending id order.
    """

    def compare(ids: list, own: list[str], following: list[str]) -> pa.RecordBatch:
        rows: list[tuple] = []
        before = (None, b"")
        for doc_id, text, after in zip(ids, own, following):
            half = len(text) // 2
            data = utf8(text[: len(text) - half] + after[:half])
            mine = before[1] if before[0] is text else fingerprint(word_hashes(utf8(text)))
            edited, theirs = fingerprint(word_hashes(data)), fingerprint(word_hashes(utf8(after)))
            rows.append((doc_id, len(text), hashlib.sha256(data).hexdigest(), mine.hex(), edited.hex(), likeness(mine, edited), likeness(mine, theirs)))
            before = (after, theirs)
        columns = list(zip(*rows)) if rows else [()] * 7
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=_NAMES)

    return with_next(docs, compare, _SCHEMA)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def near_fingerprints(queries: DataFrame, index: DataFrame, radius: int = 3) -> DataFrame:
    """All distinct pairs (a, b, distance) of fingerprints within `radius` bits.

    `queries` and `index` have a column `fingerprint` (hex); `a` is from the
    queries, `b` from the index, and a <> b. Every fingerprint of the index is
    in every block table; a block is BITS / (radius + 1) bits long.
    """
    if BITS % (4 * (radius + 1)):
        raise ValueError(f"radius + 1 must divide {BITS // 4}")
    digits = BITS // 4 // (radius + 1)

    def tables(side: DataFrame, name: str) -> DataFrame:
        blocks = F.array(*[F.struct(F.lit(i).alias("block"), F.substring("fingerprint", i * digits + 1, digits).alias("key")) for i in range(radius + 1)])
        return side.select("fingerprint").distinct().select(F.col("fingerprint").alias(name), F.explode(blocks).alias("x")).select(name, "x.block", "x.key")

    pairs = tables(queries, "a").join(tables(index, "b"), ["block", "key"]).filter("a <> b")
    return pairs.withColumn("distance", _distance("a", "b")).filter(F.col("distance") <= radius).select("a", "b", "distance").distinct()


def _distance(a: str, b: str):
    """Bits in which two hex fingerprints differ, 15 digits (60 bits) at a time."""
    total = F.lit(0)
    for at in range(1, BITS // 4 + 1, 15):
        x, y = (F.conv(F.substring(c, at, 15), 16, 10).cast("long") for c in (a, b))
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total


#: Radius up to which blocks are long enough to tell fingerprints apart.
EXACT_BITS = 15
#: Bits in which fingerprints of a likeness of 0.8 differ: cos(pi * 52 / 256) = 0.803, cos(pi * 53 / 256) = 0.796.
NEAR_BITS = 52
#: Query fingerprints that are compared in one pass over the others (32 bytes each).
SCAN_ROWS = 200_000
_SCAN_TILE = (16, 4096)


def _lanes(prints: list[str]) -> np.ndarray:
    """(LANES, prints) of hex fingerprints."""
    return np.ascontiguousarray(np.frombuffer(bytes.fromhex("".join(prints)), np.uint64).reshape(len(prints), LANES).T)


def add_near(totals: np.ndarray, asked: np.ndarray, held: np.ndarray, weights: np.ndarray, radius: int) -> None:
    """Add to `totals` for each fingerprint `asked` the weights of those `held` within `radius` bits; both are (LANES, n)."""
    half = LANES // 2
    for i in range(0, held.shape[1], _SCAN_TILE[0]):
        some = held[:, i : i + _SCAN_TILE[0], None]
        for k in range(0, asked.shape[1], _SCAN_TILE[1]):
            part = asked[:, None, k : k + _SCAN_TILE[1]]
            bits = sum(np.bitwise_count(some[lane] ^ part[lane]) for lane in range(half))
            x, y = np.nonzero(bits <= radius)  # few by chance: half of the bits differ in as many as the radius allows
            bits = bits[x, y] + sum(np.bitwise_count(held[lane, i + x] ^ asked[lane, k + y]).astype(np.int64) for lane in range(half, LANES))
            near = bits <= radius
            np.add.at(totals, k + y[near], weights[i + x[near]])


def scanned_counts(classes: DataFrame, radius: int) -> DataFrame:
    """(fingerprint, total): the rows within `radius` bits of each fingerprint asked, itself included, whatever the radius.

    `classes` has (fingerprint, n, asked). Each pass compares SCAN_ROWS of the
    fingerprints asked with all others, where these lie; no pair is a row.
    """
    asked = classes.filter("asked").select("fingerprint")
    passes = max(1, -(-asked.count() // SCAN_ROWS))
    found = []
    for i in range(passes):
        prints = sorted(r.fingerprint for r in asked.filter(F.pmod(F.xxhash64("fingerprint"), F.lit(passes)) == i).collect())
        found.append(classes.select("fingerprint", "n").mapInArrow(_scan(prints, radius), "fingerprint string, total long"))
    return reduce(DataFrame.unionByName, found).groupBy("fingerprint").agg(F.sum("total").alias("total"))


def _scan(prints: list[str], radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, totals = _lanes(prints), np.zeros(len(prints), np.int64)
        for batch in batches:
            if batch.num_rows:
                add_near(totals, asked, _lanes(batch.column("fingerprint").to_pylist()), batch.column("n").to_numpy(), radius)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array([prints[i] for i in some], pa.string()), pa.array(totals[some])], names=["fingerprint", "total"])

    return scan


def near_counts(prints: DataFrame, query: str = "doc_id % 20 = 0", radius: int = 3) -> DataFrame:
    """(fingerprint, n_near): for the fingerprints of the rows `query` selects,
    how many other rows of `prints` lie within `radius` bits (equal ones too).
    All of them are counted: up to EXACT_BITS they are found by blocks, beyond
    by comparing with every fingerprint.
    """
    if radius > EXACT_BITS:
        marked = prints.withColumn("asked", F.coalesce(F.expr(query), F.lit(False)))
        classes = saved(marked.groupBy("fingerprint").agg(F.count("*").alias("n"), F.max("asked").alias("asked")), "fingerprint-classes")
        return scanned_counts(classes, radius).select("fingerprint", (F.col("total") - 1).alias("n_near"))
    classes = prints.groupBy("fingerprint").agg(F.count("*").alias("n"))
    asked = prints.filter(query).select("fingerprint").distinct()
    pairs = near_fingerprints(asked, classes, radius)
    others = pairs.join(classes.withColumnRenamed("fingerprint", "b"), "b").groupBy(F.col("a").alias("fingerprint")).agg(F.sum("n").alias("others"))
    return (asked.join(classes, "fingerprint").join(others, "fingerprint", "left")
            .select("fingerprint", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_near")))
