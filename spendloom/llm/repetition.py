"""Quality rules on repeated substrings, by suffix arrays over words.

Each document's words get a suffix array and its longest common prefixes. An
interval of neighbours that share a prefix of l words is a repeated substring
of l words; the largest shared prefix around a suffix is the longest repeat
that starts there. Every repeat of at least `min_words` words marks its span;
the union of the spans over the document's words is the covered fraction. A
document is kept if that fraction and its longest repeat stay within limits.

The suffix arrays of a batch of documents are built together by prefix
doubling on arrays: a suffix is compared within its own document only, and a
round sorts only the suffixes that still share their prefix with another one.

Defined results: null or empty text and text without words has zero counts,
fails the base rule and is not kept. Repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spendloom.llm.common import by_batch, texts, utf8, word_hashes

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
BASE_WORDS = 50  # fewer words fail
BASE_REPEAT_PERCENT = 50  # a larger share of words in repeated windows fails
WINDOW = 3
#: Words handled at once; a longer document is handled alone.
GROUP_WORDS = 200_000


def longest_repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest repeat that starts there.

    `words` are word hashes of documents laid end to end, `doc` the document
    number of each, in order. A repeat lies in one document and may overlap
    itself.
    """
    n = len(words)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    # level 0: suffixes grouped by document and first word
    order = np.lexsort((words, doc))
    new = np.ones(n, bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    end = np.searchsorted(doc, doc, side="right")  # one past the document's last word
    levels, width = [rank], 1
    open_ = order[~(new & np.append(new[1:], True))]  # suffixes that share their group, in order
    while len(open_):
        after = open_ + width
        inside = after < end[open_]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[open_]
        by = np.lexsort((second, first))
        open_, first, second = open_[by], first[by], second[by]
        starts = np.ones(len(open_), bool)
        starts[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        # a group's rank is its first place in the order of all suffixes
        at = np.arange(len(open_))
        group = np.ones(len(open_), bool)
        group[1:] = first[1:] != first[:-1]
        place = first + at - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[open_] = place[np.maximum.accumulate(np.where(starts, at, 0))]
        order[place] = open_
        levels.append(rank)
        width *= 2
        open_ = open_[~(starts & np.append(starts[1:], True))]
    # neighbours in suffix order that share at least their first word
    left, right = order[:-1], order[1:]
    pairs = levels[0][left] == levels[0][right]
    left, right = left[pairs], right[pairs]
    lcp = np.zeros(len(left), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = left + lcp, right + lcp
        same = (a < end[left]) & (b < end[right])
        same[same] = levels[level][a[same]] == levels[level][b[same]]
        lcp[same] += 1 << level
    np.maximum.at(best, left, lcp)
    np.maximum.at(best, right, lcp)
    return best


def covered(lengths: np.ndarray, doc_start: np.ndarray, least: int) -> np.ndarray:
    """Per document, the words inside the union of the repeats of `least` words or more.

    `lengths` is the result of `longest_repeats`, `doc_start` the place of each
    document's first word; repeats never run past their document.
    """
    n = len(lengths)
    reach = np.where(lengths >= least, np.arange(n) + lengths, 0)
    inside = np.maximum.accumulate(reach) > np.arange(n) if n else np.zeros(0, bool)
    total = np.concatenate([[0], np.cumsum(inside)])
    return total[np.append(doc_start[1:], n)] - total[doc_start] if len(doc_start) else np.zeros(0, np.int64)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if utf8(line).split()]
    return len(lines) - len(set(lines))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10,
                  max_covered: float = 0.25, max_repeat: int = 50) -> DataFrame:
    """One row per row of `docs`: base counts, base rule, repetition, verdict.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, covered_words (words in repeats of
    `min_words` or more), longest_repeat (words), kept. `kept` asks for the
    base rule, covered_words <= max_covered * n_words and longest_repeat <=
    max_repeat.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]

    def repeats(group: list[np.ndarray]) -> list[tuple[int, int, int]]:
        sizes = np.array([len(w) for w in group])
        start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        lengths = longest_repeats(np.concatenate(group), np.repeat(np.arange(len(group)), sizes))
        longest = [int(lengths[s : s + k].max()) if k else 0 for s, k in zip(start, sizes)]
        # an empty document shares its start with the next one and covers nothing
        return list(zip(covered(lengths, start, WINDOW).tolist(), covered(lengths, start, min_words).tolist(), longest))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        values: dict[str, list[int]] = {c: [] for c in names}
        found: list[tuple[int, int, int]] = []
        group: list[np.ndarray] = []
        held = 0
        for text in batch.column("text").to_pylist():
            words = word_hashes(utf8(text))
            values["n_words"].append(len(words))
            values["word_chars"].append(len(text) - sum(map(text.count, WHITE)))
            values["n_symbols"].append(sum(map(text.count, SYMBOLS)))
            values["n_dup_lines"].append(duplicate_lines(text))
            group.append(words)
            held += len(words)
            if held >= GROUP_WORDS:
                found += repeats(group)
                group, held = [], 0
        if group:
            found += repeats(group)
        values["n_repeat_words"], values["covered_words"], values["longest_repeat"] = (list(x) for x in zip(*found))
        n_words, repeated, cover, longest = (np.array(values[c]) for c in ("n_words", "n_repeat_words", "covered_words", "longest_repeat"))
        failed = (n_words < BASE_WORDS) | (100 * repeated > BASE_REPEAT_PERCENT * n_words)
        kept = ~failed & (cover <= max_covered * n_words) & (longest <= max_repeat)
        columns = [batch.column("doc_id"), *(pa.array(values[c], pa.int64()) for c in names), pa.array(failed), pa.array(kept)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, "base_failed", "kept"])

    return by_batch(texts(docs, id_col, text_col), judge,
                    f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, kept boolean")
