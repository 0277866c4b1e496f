"""Best-fit packing of tokenised documents into sequences of fixed length.

A document is its token ids and one closing id. A document longer than a
sequence is cut from its end into whole sequences; what is left over is its
first piece. Pieces are then packed by bulk-synchronous best fit:

* Pieces are range-sorted by length. Pieces of one length are interchangeable,
  so a length and how many pieces have it stand for all of them: at most
  `capacity` rows whatever the size of the table, and the same holds for gaps.
* A round takes the longest length that is left and sweeps the gaps upwards
  from it, so every piece meets the smallest gap that holds it. Pieces that
  want the same gap are told apart by rank: the i-th piece of a length gets
  the i-th place. Pieces that no gap holds open sequences. Gaps are updated
  and the next length follows: best-fit decreasing, in at most `capacity`
  rounds.
* Each piece's rank within its length is computed where the rows are, in
  hashed chunks, so a length that a third of all pieces share is many small
  groups; a join on (length, block of ranks) hands out the places.

Defined results: null text is empty and gives one piece with the closing id
alone; an empty table gives no rows; repeated rows are packed each.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendloom.llm.common import by_batch, saved, texts
from spendloom.llm.token_counts import byte_level_entries

CHUNK_ROWS = 50_000
BLOCK = 4096
_SPACES = re.compile(r"\s\s")


#: Fixed value: how byte-level tokenizers cut a text before they merge bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes are alike in every regular-expression library.
_PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-\u024f]*").fullmatch


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    A byte-level tokenizer cuts a text at white space before it merges
    anything, and a single space between two other characters always begins a
    new cut. So a text without two white-space characters in a row is encoded
    word by word, and a word's ids are remembered; any other text is encoded
    whole. New plain words go through `tiktoken`, which holds the same
    vocabulary and is several times faster; words with other characters or
    with special tokens go through `tokenizers` itself.
    """

    def __init__(self, path: str, limit: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        entries = byte_level_entries(path)
        self.plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=entries, special_tokens={})
        self.begins = np.zeros(max(entries.values()) + 1, bool)  # entries that begin with a space
        self.begins[[i for piece, i in entries.items() if piece[:1] == b" "]] = True
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Remember the ids of words; all but a text's first begin with their one space."""
        known, many = self.known, []
        for word in words:
            if _PLAIN(word) and not any(s in word for s in self.special):
                if word[:1] == " ":
                    many.append(word)
                else:
                    known[word] = np.array(self.plain.encode_ordinary(word), "<u4").tobytes()
            else:
                known[word] = self.whole(word)
        if many:
            ids = np.array(self.plain.encode_ordinary("".join(many)), "<u4")
            starts = np.flatnonzero(self.begins[ids]) * 4
            data = ids.tobytes()
            known.update(zip(many, map(data.__getitem__, map(slice, starts.tolist(), [*starts[1:].tolist(), len(data)]))))

    def encode(self, batch: list[str]) -> Iterator[bytes]:
        known = self.known
        cut = [None if "\0" in t or _SPACES.search(t) else t.replace(" ", "\0 ").split("\0") for t in batch]
        words = set().union(*filter(None, cut))
        missing = words - known.keys()
        if len(known) + len(missing) > self.limit:
            known.clear()
            missing = words
        self.learn(list(missing))
        for text, words in zip(batch, cut):
            yield self.whole(text) if words is None else b"".join(map(known.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, limit: int) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, limit)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, closing_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", keep_ids: bool = False, remembered: int = 300_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) per piece.

    `ids` (with `keep_ids`) are the piece's ids as little-endian unsigned
    32-bit bytes, `ids_crc32` their checksum. `tokenizer` is the path of a
    tokenizer file every executor can open; `remembered` bounds a worker's
    table of encoded words.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    closing = np.array([closing_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, values = [], []
        texts_ = batch.column("text").to_pylist()
        coder = encoder(tokenizer, remembered)
        for at in range(0, len(texts_), 256):
            for i, ids in enumerate(coder.encode(texts_[at : at + 256]), at):
                ids = memoryview(ids + closing)
                n, start, piece = len(ids) // 4, 0, 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    part = ids[4 * start : 4 * (start + length)]
                    row.append(i)
                    values.append((piece, start, length, zlib.crc32(part)) + ((part.tobytes(),) if keep_ids else ()))
                    start, piece = start + length, piece + 1
        columns = [pa.array(c, t) for c, t in zip(zip(*values), types)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *columns], names=names)

    return by_batch(texts(docs, id_col, text_col), cut,
                    f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)


class Places(NamedTuple):
    """Places for the pieces of one length with ranks from `rank` on.

    `sequences` sequences from number `first` on take `each` pieces in a row,
    beginning at `offset`; the last of them may take fewer.
    """

    length: int
    rank: int
    pieces: int
    first: int
    each: int
    offset: int


def best_fit(counts: dict[int, int], capacity: int) -> list[Places]:
    """Best-fit decreasing over lengths and their counts; see the module text."""
    places: list[Places] = []
    sizes: list[int] = []  # distinct gaps that are open, sorted
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> ranges (first sequence, how many)
    opened = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = gap // length
            used = min(left, n * each)
            places.append(Places(length, rank, used, first, each, capacity - gap))
            full, rest = divmod(used, each)
            leave(gap - each * length, first, full)
            if rest:
                leave(gap - rest * length, first + full, 1)
            touched = full + bool(rest)
            leave(gap, first + touched, n - touched)
            rank, left = rank + used, left - used
    return places


def best_fit_packing(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add (sequence_id, offset) to `pieces`, which has doc_id, piece and length.

    No sequence exceeds `capacity`; each is filled from 0 without gaps. The
    driver gets one row per distinct length, `capacity` at most.
    """
    spark = pieces.sparkSession
    pieces = saved(pieces, "pieces")
    sizes = pieces.groupBy("length").count().collect()
    counts = {r.length: r["count"] for r in sizes}
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("a piece is empty or longer than a sequence")
    places = spark.createDataFrame(best_fit(counts, capacity) or [], "length long, rank long, pieces long, first long, each long, offset long")
    chunks = spark.createDataFrame([(length, -(-n // CHUNK_ROWS)) for length, n in counts.items()], "length long, chunks long")
    # rank within the length: place within a chunk, after all earlier chunks
    dealt = pieces.join(F.broadcast(chunks), "length").withColumn("chunk", F.expr("pmod(xxhash64(doc_id, piece), chunks)"))
    sums = dealt.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n")
    sums = sums.select("length", "chunk", before.alias("before"))
    own = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", *[c for c in ("ids_crc32",) if c in pieces.columns])
    ranked = (dealt.withColumn("row", F.row_number().over(own)).join(sums, ["length", "chunk"])
              .withColumn("at", F.col("before") + F.col("row") - 1).withColumn("block", F.expr(f"at div {BLOCK}")))
    blocks = places.withColumn("block", F.explode(F.expr(f"sequence(rank div {BLOCK}, (rank + pieces - 1) div {BLOCK})")))
    placed = ranked.join(blocks, ["length", "block"]).filter("at >= rank and at < rank + pieces")
    return placed.select(*pieces.columns, F.expr("first + (at - rank) div each").alias("sequence_id"),
                         F.expr("offset + pmod(at - rank, each) * length").alias("offset"))
