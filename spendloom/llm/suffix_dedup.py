"""Removal of long repeated byte strings with a logarithmic family of suffix indexes.

Every byte covered by a string of `length` bytes that also starts anywhere
else in the corpus is removed; strings are judged on the input.

Suffixes. A full suffix array holds every byte position; for matches of
`length` bytes or more it is enough to hold some suffixes, provided equal
strings choose alike. Each window of `length` bytes chooses the position in it
whose next GRAM bytes have the smallest hash (the leftmost of equals), about
one position in 140 bytes. A chosen suffix is kept with the run of windows
that chose it. Suffixes are ordered by the fingerprint of their first GRAM
bytes: a sparse suffix array in which equal beginnings are neighbours.

Index family. A batch of documents gets such an array, sorted and written. It
is merge-scanned against itself and every existing level; beginnings that
occur more than once are noted. Two levels of equal size are merged into one
of twice the size when the next batch arrives, so there are logarithmically
many levels and a suffix is rewritten logarithmically often.

Long matches. Suffixes with a shared beginning are settled in rounds. A round
cuts a suffix's run of windows into nodes by offset. If the union of a node's
windows occurs twice, all its windows do; if their common core occurs once,
none does; else the node is cut finer, down to single windows. One witness of
each settled class stays in the next round, so a partly equal suffix still
meets it. Counts are aggregations with map-side combine: a passage in a third
of all documents is one row per task.

Fingerprints are 64-bit polynomials modulo 2^64 with random byte values, two of
them (core and union) for a match. Defined results: null text is empty; texts
shorter than `length` lose nothing; a repeated row loses all that is long
enough; spans count bytes of the UTF-8 text and may cut a character.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import by_batch, mix64, saved, texts

LENGTH = 400
GRAM = 128
#: Offsets per node in the rounds after the first.
STEPS = (18, 1)
GROUP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown as needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def need(cls, n: int) -> None:
        if len(cls.up) < n:
            size = max(n, GROUP_BYTES + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))


class Hashed:
    """Fingerprints of all substrings of some bytes, by prefix sums."""

    def __init__(self, data: bytes):
        values = np.frombuffer(data, np.uint8)
        self.n = len(values)
        _Powers.need(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[values] * _Powers.up[: self.n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * _Powers.down[start]
        return mix64(value + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        return mix64((self.sums[size:] - self.sums[: self.n + 1 - size]) * _Powers.down[: self.n + 1 - size] + np.uint64(size))


def chosen(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` grams, the place of its smallest (leftmost) one."""
    n, bits = len(grams) - width + 1, np.uint64(21)
    out = []
    for at in range(0, n, GROUP_BYTES):
        part = grams[at : at + GROUP_BYTES + width - 1]
        low = (part >> bits << bits) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[: len(part) - width + 1], low[width - size : len(part) - size + 1])
        out.append((low & np.uint64((1 << 21) - 1)).astype(np.int64) + at)
    return np.concatenate(out)


def suffix_runs(hashed: Hashed, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, near, far) of the chosen suffixes of documents laid end to end.

    The windows that chose a suffix start `near` to `far` bytes before it;
    `ends` are the documents' ends, `place` counts from the first one's start.
    """
    if hashed.n < length:
        return (np.zeros(0, np.int64),) * 4
    place = chosen(hashed.grams(gram), length - gram + 1)
    start = np.arange(len(place))
    doc = np.searchsorted(ends, start, side="right")
    inside = start + length <= ends[np.minimum(doc, len(ends) - 1)]
    place, start, doc = place[inside], start[inside], doc[inside]
    if not len(place):
        return (np.zeros(0, np.int64),) * 4
    new = np.append(True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    return doc[first], place[first], place[last] - start[last], place[first] - start[first]


def nodes(hashed: Hashed, place: np.ndarray, near: np.ndarray, far: np.ndarray, step: int, length: int) -> tuple[np.ndarray, ...]:
    """Cut runs of windows by offset: (run, near, far, core, union) of each node.

    `place` counts in the hashed bytes. Offsets are cut at multiples of `step`.
    """
    low = near // step
    many = far // step - low + 1
    run = np.repeat(np.arange(len(place)), many)
    cell = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many) + low[run]
    first, last = cell * step, cell * step + step - 1
    n, f, p = np.maximum(first, near[run]), np.minimum(last, far[run]), place[run]
    # the core lies in every window of the whole node, and so in those there are
    last = np.minimum(last, length - 1)
    core = hashed.of(p - first, p - last + length)
    union = hashed.of(p - f, p - n + length)
    core = mix64(core + cell.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    union = mix64(union ^ mix64((n - first).astype(np.uint64) * np.uint64(1 << 20) + (f - first).astype(np.uint64)))
    return run, n, f, core, union


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


_NODE_NAMES = ["core", "union", "row", "place", "near", "far"]
_NODE = "core long, union long, row long, place long, near int, far int"


def _node_batch(parts: list[tuple]) -> pa.RecordBatch | None:
    if not parts:
        return None
    core, union, row, place, near, far = (np.concatenate(c) for c in zip(*parts))
    return pa.RecordBatch.from_arrays([_long(core), _long(union), pa.array(row, pa.int64()), pa.array(place, pa.int64()), pa.array(near, pa.int32()), pa.array(far, pa.int32())],
                                      names=_NODE_NAMES)


def suffixes(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The sparse suffix array of (row, text): one row per chosen suffix, not yet sorted."""
    width = length - gram + 1

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts: list[tuple] = []
        held: list[bytes] = []
        ids: list[int] = []

        def close() -> None:
            ends = np.cumsum([len(d) for d in held])
            starts = ends - [len(d) for d in held]
            hashed = Hashed(b"".join(held))
            doc, place, near, far = suffix_runs(hashed, ends, length, gram)
            if len(doc):
                _, near, far, core, union = nodes(hashed, place, near, far, width, length)
                parts.append((core, union, np.array(ids, np.int64)[doc], place - starts[doc], near, far))
            held.clear()
            ids.clear()

        size = 0
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            if len(data) < length:
                continue
            held.append(data)
            ids.append(row)
            size += len(data)
            if size >= GROUP_BYTES:
                close()
                size = 0
        if held:
            close()
        return _node_batch(parts)

    return by_batch(rows, choose, _NODE)


class SuffixIndex:
    """Levels of sorted suffix arrays; `add` merge-scans a batch against them."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []  # (batches in it, array), largest first
        self.shared: list[DataFrame] = []  # beginnings known to occur more than once

    def add(self, batch: DataFrame) -> None:
        """`batch` is what `suffixes` gives for new documents."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (m, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((n + m, self._sorted(a.unionByName(b))))
        array = self._sorted(batch)
        counts = array.groupBy("core").agg(F.count("*").alias("n"))
        found = counts.filter("n > 1").select("core")
        for _, level in self.levels:
            found = found.unionByName(counts.select("core").join(level.select("core"), "core", "left_semi"))
        self.shared.append(saved(found.distinct(), "shared"))
        self.levels.append((1, array))

    @staticmethod
    def _sorted(array: DataFrame) -> DataFrame:
        return saved(array.repartition("core").sortWithinPartitions("core"), "suffixes")

    def candidates(self) -> DataFrame:
        """All suffixes whose beginning occurs more than once."""
        shared = self.shared[0]
        for more in self.shared[1:]:
            shared = shared.unionByName(more)
        arrays = [level for _, level in self.levels]
        union = arrays[0]
        for array in arrays[1:]:
            union = union.unionByName(array)
        return union.join(shared.distinct(), "core", "left_semi")


def _settled(found: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Spans of nodes whose union occurs twice, and the runs to cut finer."""
    classes = saved(found.groupBy("core", "union").agg(F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("place", "row").alias("place"),
                                                      F.first("near").alias("near"), F.first("far").alias("far")), "classes")
    span = (F.col("place") - F.col("far")).alias("start"), (F.col("place") - F.col("near") + length).alias("end")
    spans = found.join(classes.filter("n > 1").select("core", "union"), ["core", "union"], "left_semi").select("row", *span)
    cores = classes.groupBy("core").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 and least = 1")
    finer = classes.join(cores.select("core"), "core", "left_semi").select("row", "place", "near", "far")
    return spans, finer


def _cut(held: DataFrame, runs: DataFrame, step: int, length: int) -> DataFrame:
    """Nodes of `runs`, made from the texts of their documents."""
    listed = runs.groupBy("row").agg(F.collect_list(F.struct("place", "near", "far")).alias("runs"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts: list[tuple] = []
        runs_ = batch.column("runs")
        for i, (row, text) in enumerate(zip(batch.column("row").to_pylist(), batch.column("text").to_pylist())):
            own = runs_[i].values
            place, near, far = (own.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "near", "far"))
            run, near, far, core, union = nodes(Hashed(text.encode("utf-8", "surrogatepass")), place, near, far, step, length)
            parts.append((core, union, np.full(len(run), row, np.int64), place[run], near, far))
        return _node_batch(parts)

    return by_batch(held.join(listed, "row").select("row", "text", "runs"), cut, _NODE)


def repeated_spans(docs: DataFrame, batches: int = 4, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(row, start, end) of repeated strings, and the (row, text) of documents that share a beginning.

    `docs` has (row, text), where `row` names a text. Spans may overlap.
    """
    index = SuffixIndex()
    for i in range(batches):
        index.add(suffixes(docs.filter(F.expr(f"pmod(row, {batches}) = {i}")), length, gram))
    found = saved(index.candidates(), "candidates")
    held = saved(docs.join(found.select("row").distinct(), "row", "left_semi"), "texts")
    spans, runs = _settled(found, length)
    spans = saved(spans, "spans")
    once = held.dropDuplicates(["row"])
    for step in STEPS:
        found = _cut(once, runs, step, length)
        # a core that occurs once settles its node
        found = saved(found, "nodes")
        shared = found.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1")
        more, runs = _settled(found.join(shared.select("core"), "core", "left_semi"), length)
        spans = spans.unionByName(saved(more, "spans"))
    return spans, held


def remove_repeats(docs: DataFrame, batches: int = 4, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) per row of `docs`.

    `spans` are the maximal removed runs as (start, end) in bytes, null if none.
    """
    named = texts(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))
    spans, held = repeated_spans(named.select("row", "text"), batches, length, gram)
    listed = spans.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("found"))

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        found = batch.column("found")
        for i, (row, text) in enumerate(zip(batch.column("row").to_pylist(), batch.column("text").to_pylist())):
            data = text.encode("utf-8", "surrogatepass")
            own = found[i].values
            start, end = (own.field(c).to_numpy(zero_copy_only=False) for c in ("start", "end"))
            by = np.argsort(start, kind="stable")
            start, reach = start[by], np.maximum.accumulate(end[by])
            new = np.append(True, start[1:] > reach[:-1])
            start, end = start[new].tolist(), np.append(reach[:-1][new[1:]], reach[-1]).tolist()
            kept = b"".join(data[a:b] for a, b in zip([0, *end], [*start, len(data)]))
            out.append((row, len(data) - len(kept), len(start), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in zip(start, end)]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=["row", "n_removed", "n_spans", "kept_sha256", "spans"])

    lost = by_batch(held.dropDuplicates(["row"]).join(listed, "row").select("row", "text", "found"), remove,
                    "row long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>")
    whole = named.select("doc_id", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    return (whole.join(saved(lost, "lost"), "row", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                    F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "spans"))
