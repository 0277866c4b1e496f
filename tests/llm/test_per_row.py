"""Token counts, fingerprints, quality rules and page text against brute force."""

import hashlib
import html
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
from llm_helpers import words_of
from pyspark.sql import functions as F

from spendloom.llm import fingerprints as fp
from spendloom.llm import html_text, repetition, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def greedy(pieces, word):
    longest, at, n = max(map(len, pieces)), 0, 0
    while at < len(word):
        end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_automaton_equals_greedy_longest_match():
    rnd = random.Random(1)
    for _ in range(200):
        pieces = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(1, 8))]
        automaton = token_counts.LongestMatch(pieces)
        for _ in range(40):
            word = bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 20)))
            assert automaton.count(word) == greedy(set(pieces), word)


def test_token_counts(docs, rows, empty):
    pieces = set(token_counts.byte_level_entries(BYTE_BPE))
    got = token_counts.token_counts(docs, BYTE_BPE)
    want = Counter()
    for doc_id, text, *_ in rows:
        counts = [greedy(pieces, b" " + w) for w in words_of(text)]
        want[doc_id, len(counts), sum(counts), 0, max(counts, default=0)] += 1
    assert Counter(tuple(r) for r in got.collect()) == want
    assert token_counts.token_counts(empty, BYTE_BPE).count() == 0


def test_fingerprint_is_the_sign_of_the_votes():
    words = np.frombuffer(random.Random(2).randbytes(8 * 700), np.uint64)
    terms, counts = np.unique(fp.shingle_hashes(words, 2), return_counts=True)
    votes = np.zeros(fp.BITS)
    for term, n in zip(terms, counts):
        bits = np.unpackbits(np.concatenate([fp.mix64(term + s) for s in fp._LANE_SALTS]).view(np.uint8).reshape(fp.LANES, 8), axis=1, bitorder="little")
        # bit i of byte j of a lane is place (i, lane, j)
        votes += (2.0 * bits.reshape(fp.LANES, 8, 8).transpose(2, 0, 1).ravel() - 1) * (1 + int(np.log2(n)))
    assert fp.fingerprint(words) == np.packbits(votes > 0).tobytes()


def test_fingerprints_with_edits(docs, rows, empty):
    got = fp.fingerprints_with_edits(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).collect()
    order = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter()
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        text = t[: len(t) - half] + after[:half]
        want[i, len(t), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    texts = dict(order)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert fp.fingerprints_with_edits(empty.select("doc_id", "text")).count() == 0


def test_near_fingerprints_against_all_pairs(spark):
    rnd = random.Random(3)
    base = [rnd.getrandbits(256) for _ in range(40)]
    prints = base + [b ^ sum(1 << rnd.randrange(256) for _ in range(rnd.randint(0, 6))) for b in base for _ in range(3)]
    hexed = [f"{p:064x}" for p in prints] * 2
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hexed)], "doc_id long, fingerprint string")
    got = {(r.a, r.b): r.distance for r in fp.near_fingerprints(df, df).collect()}
    unique = sorted(set(prints))
    want = {(f"{a:064x}", f"{b:064x}"): (a ^ b).bit_count() for a in unique for b in unique if a != b and (a ^ b).bit_count() <= 3}
    assert got == want and got
    counts = {r.fingerprint: r.n_near for r in fp.near_counts(df).collect()}
    for i in range(0, len(hexed), 20):
        assert counts[hexed[i]] == sum((int(hexed[i], 16) ^ int(h, 16)).bit_count() <= 3 for h in hexed) - 1


def longest_brute(words):
    out = [0] * len(words)
    for i in range(len(words)):
        for j in range(len(words)):
            k = 0
            while i != j and i + k < len(words) and j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def test_suffix_array_repeats():
    rnd = random.Random(5)
    for _ in range(150):
        documents = [[rnd.randint(0, rnd.choice([1, 3, 9])) for _ in range(rnd.randint(0, 25))] for _ in range(rnd.randint(1, 5))]
        sizes = [len(d) for d in documents]
        flat = np.array([w for d in documents for w in d], np.uint64)
        lengths = repetition.longest_repeats(flat, np.repeat(np.arange(len(documents)), sizes))
        assert lengths.tolist() == [n for d in documents for n in longest_brute(d)]


def test_quality_rules(docs, rows, empty):
    got = repetition.quality_rules(docs).collect()
    want = Counter()
    for doc_id, text, *_ in rows:
        words, text = words_of(text), text or ""
        if len(words) > 1000:
            continue
        lines, seen, repeated = [x for x in text.split("\n") if words_of(x)], set(), 0
        for line in lines:
            repeated += line in seen
            seen.add(line)
        lengths = longest_brute(words)
        covered = {least: len({k for i, n in enumerate(lengths) if n >= least for k in range(i, i + n)}) for least in (3, 10)}
        failed = len(words) < 50 or 100 * covered[3] > 50 * len(words)
        kept = not failed and covered[10] <= 0.25 * len(words) and max(lengths, default=0) <= 50
        want[doc_id, len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text)), repeated, covered[3], covered[10],
             max(lengths, default=0), failed, kept] += 1
    assert Counter(tuple(r) for r in got if r.n_words <= 1000) == want
    assert repetition.quality_rules(empty).count() == 0


PAGES = {
    "<html><body><header><p>Site name</p></header><div class='content'><p>Main text one &amp; two.</p><aside><p>side</p></aside><p>More <a href=x>linked</a>\n  text.</p></div>"
    "<section class='comments'><p>I like this a lot yes really</p></section><footer>f</footer></body></html>": "Main text one & two.\nMore linked text.",
    "<nav><a>x</a><a>y</a><article><p>Body a < b</p></article>": "Body a < b",
    "<div id='cookie-notice'><p>We use cookies and more words here</p></div><main><h1>T</h1><p>x y z</p><form><p>form</p></form><ul><li>one</li><li>two</li></ul></main>": "T\nx y z\none\ntwo",
    "": "", None: "", "just text": "just text", "<p class=ad>buy<p>keep this": "keep this", "<script>var a='<p>no</p>'": "", "<p>x": "x",
    "<article><p>a</p><div class=\"ad\">no</div><p>b</p></article><div class=more><p>foo bar</p></div>": "a\nb",
    "<article><p>open <b>bold<br><p>&eacute;&#33;&nbsp;z": "open bold\né! z",
    "<": "<", "<nav>" * 50: "", "<!-- <p>hidden</p> --><p>seen</p>": "seen",
}


def test_page_text(spark, empty):
    rows = [(i, f"u{i}", h, "kept") for i, h in enumerate(PAGES)] * 2 + [(None, None, "<p>null id</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract_text(pages).collect()]
    want = [(i, f"u{i}", t, len(t)) for i, t in enumerate(PAGES.values())] * 2 + [(None, None, "null id", 7)]
    assert Counter(got) == Counter(want)
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_articles_of_the_given_pages():
    import duckdb
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (source,) in rows:
        inside = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside))
        assert html_text.main_text(source, {}) == "\n".join(filter(None, blocks))


def test_best_run_is_the_maximum_sum():
    rnd = random.Random(6)
    for _ in range(300):
        scores = [rnd.randint(-5, 5) for _ in range(rnd.randint(0, 12))]
        a, b = html_text.best_run(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0)
        assert sum(scores[a:b]) == max(best, 0)
