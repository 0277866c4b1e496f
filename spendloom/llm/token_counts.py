"""Token counts by a linear longest-match automaton.

Greedy word-piece tokenisation takes, again and again, the longest vocabulary
entry that starts where the last one ended. Restarting the match at every
piece costs time in proportion to word length times entry length. The
automaton here reads every byte once: the vocabulary is a trie, and each node
carries a failure link together with the number of pieces that are complete
when that link is taken (Song et al. 2021, "Fast WordPiece Tokenization").
Only lengths and counts are kept; no piece is ever built.

A vocabulary entry that begins a word is written with one leading space
(0x20), one that continues a word without. A word is matched as a space and
its UTF-8 bytes. The vocabulary of the queries holds the space and every
single byte, so every word can be matched; with a vocabulary that cannot
match a word, the word counts as one unknown token.

Defined results: null and empty text give 0 words and 0 tokens; a repeated
row gives a repeated result; a null id passes through.
"""

from __future__ import annotations

import json
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from spendloom.llm.common import by_batch, texts

NONE = -1


class LongestMatch:
    """Trie with failure links and popped-token counts over byte strings."""

    def __init__(self, vocabulary: list[bytes]):
        children: list[dict[int, int]] = [{}]
        entry = [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                step = children[node].get(byte)
                if step is None:
                    step = len(children)
                    children[node][byte] = step
                    children.append({})
                    entry.append(False)
                node = step
            entry[node] = node != 0
        # fail[v]: the node for what is left of v's string after its longest
        # entries are taken off the front; popped[v]: how many are taken off.
        fail, popped = [NONE] * len(children), [0] * len(children)
        queue = deque((child, 0, byte) for byte, child in children[0].items())
        while queue:
            node, parent, byte = queue.popleft()
            if entry[node]:
                fail[node], popped[node] = 0, 1
            else:
                at, count = fail[parent], popped[parent]
                while at != NONE and byte not in children[at]:
                    count += popped[at]
                    at = fail[at]
                if at != NONE:
                    fail[node], popped[node] = children[at][byte], count
            queue.extend((child, node, b) for b, child in children[node].items())
        self.children, self.fail, self.popped = children, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; NONE if there is no match."""
        children, fail, popped = self.children, self.fail, self.popped
        node = count = 0
        for byte in word:
            step = children[node].get(byte)
            while step is None:
                count += popped[node]
                node = fail[node]
                if node == NONE:
                    return NONE
                step = children[node].get(byte)
            node = step
        while node != 0:  # take off what is left
            count += popped[node]
            node = fail[node]
            if node == NONE:
                return NONE
        return count


def byte_level_entries(path: str) -> dict[bytes, int]:
    """Entries of a byte-level BPE tokenizer file, as bytes, and their ids.

    Such files write every byte as one printable character: the printable
    bytes of Latin-1 stand for themselves, the others for U+0100 onwards.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    to_byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(to_byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}


class CountedWords(dict):
    """word -> (tokens, unknown) by the automaton, remembered up to `limit` words."""

    def __init__(self, automaton: LongestMatch, limit: int):
        self.automaton, self.limit = automaton, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.automaton.count(b" " + word)
        return value


_MEMO: dict[str, CountedWords] = {}


def counted_words(path: str, limit: int) -> CountedWords:
    """One automaton a worker process and vocabulary file."""
    if path not in _MEMO:
        _MEMO[path] = CountedWords(LongestMatch(list(byte_level_entries(path))), limit)
    return _MEMO[path]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 remembered: int = 400_000) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown, longest_word_tokens) per row of `docs`.

    `vocabulary` is the path of a byte-level BPE tokenizer file that every
    executor can open. Words are the runs of `[^\\x20\\x09-\\x0D]+`.
    `remembered` bounds the worker's table of words already counted; it
    changes nothing but time.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo = counted_words(vocabulary, remembered)
        words, tokens, unknown, longest = [], [], [], []
        for text in batch.column("text").to_pylist():
            counts = [memo[w] for w in text.encode("utf-8", "surrogatepass").split()]
            missed = counts.count(NONE)
            words.append(len(counts))
            tokens.append(sum(counts) + 2 * missed)  # -1 becomes one unknown token
            unknown.append(missed)
            longest.append(max(max(counts), 1) if counts else 0)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown, longest))],
            names=["doc_id", "n_words", "n_tokens", "n_unknown", "longest_word_tokens"])

    return by_batch(texts(docs, id_col, text_col), count,
                    f"doc_id {kind}, n_words long, n_tokens long, n_unknown long, longest_word_tokens long")
