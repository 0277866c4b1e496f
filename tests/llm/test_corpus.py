"""Operators over the whole corpus against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import words_of
from pyspark.sql import functions as F

from spendloom.llm import jaccard_join, line_dedup, mixing, packing, suffix_dedup, toxicity
from spendloom.llm.common import components, linked_groups

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def of(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.of(a), self.of(b)))
        self.up[b] = a


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(60)] + [(900, 900 + i) for i in range(40)]
    groups = Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.of(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_linked_groups_lose_no_link(spark):
    # numbers link if they differ by 3 at most; all of them share one bucket
    keys = random.Random(2).sample(range(600), 150)
    buckets = spark.createDataFrame([(0, k) for k in keys], "sig long, key long").withColumn("facts", F.struct(F.lit(0).alias("x")))
    got = {r.id: r.component for r in linked_groups(buckets, lambda p: p.withColumn("links", F.abs(F.col("a") - F.col("b")) <= 3)).collect()}
    groups = Groups(keys)
    for a in keys:
        for b in keys:
            if a < b <= a + 3:
                groups.join(a, b)
    assert {k: got.get(k, k) for k in keys} == {k: groups.of(k) for k in keys}


def jaccard_brute(rows, percent, width):
    sets = [set(jaccard_join.shingle_set(t or "", width).tolist()) for _, t, *_ in rows]
    groups = Groups(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                groups.join(i, j)
    members = defaultdict(list)
    for i, (doc_id, *_) in enumerate(rows):
        members[groups.of(i)].append(doc_id)
    lowest = {g: min((m for m in ms if m is not None), default=None) for g, ms in members.items()}
    return Counter((rows[i][0], len(s), lowest[groups.of(i)] if s else rows[i][0]) for i, s in enumerate(sets))


@pytest.mark.parametrize("percent, width", [(85, 4), (80, 5)])
def test_jaccard_groups(docs, rows, percent, width):
    got = jaccard_join.jaccard_groups(docs, percent, width).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_brute(rows, percent, width)


@pytest.mark.parametrize("rare", [1, 3, 12])
def test_jaccard_groups_of_many_near_copies(spark, monkeypatch, rare):
    monkeypatch.setattr(jaccard_join, "RARE", rare)
    rnd = random.Random(7)
    base = ["w%d" % rnd.randrange(5000) for _ in range(90)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        words = list(base)
        for _ in range(rnd.randint(0, 6)):
            words[rnd.randrange(len(words))] = "n%d" % rnd.randrange(10**6)
        if i % 40 == 0:
            words = words[: rnd.randint(1, 90)]
        rows.append((i, " ".join(words)))
    got = jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_brute(rows, 85, 4)


def test_signatures_of_similar_sets_meet():
    rnd = random.Random(8)
    hashes = lambda n: [rnd.getrandbits(64) for _ in range(n)]
    common = np.array(sorted(hashes(50)), np.uint64)
    for _ in range(1500):
        n = rnd.choice([1, 2, 5, 6, 7, 13, 30, 90, 400])
        x = set(rnd.sample(common.tolist(), min(n, rnd.choice([0, 0, 3, 40]))) + hashes(n))
        y = set(list(x)[rnd.randint(0, max(1, len(x) // 8)) :]) | set(hashes(rnd.randint(0, max(1, len(x) // 9))))
        both = len(x & y)
        if x != y and 100 * both >= 85 * (len(x) + len(y) - both):
            a, b = (set(jaccard_join.signatures(np.array(sorted(s), np.uint64), jaccard_join.Bands(85), common).tolist()) for s in (x, y))
            assert a & b


def test_one_of_each_group(docs, rows, empty):
    kept = jaccard_join.one_of_each_group(docs).collect()
    assert kept and set(kept[0].asDict()) == set(docs.columns) and all(r.score == "kept" for r in kept)
    want = jaccard_brute(rows, 80, 5)
    stays = Counter(r.doc_id for r in kept)
    for (doc_id, n, component), times in want.items():
        if n == 0:
            continue
        assert stays[doc_id] == (1 if doc_id == component else 0) or doc_id is None
    assert stays[None] == 1  # the row without a text; the other is a copy of document 10
    assert jaccard_join.one_of_each_group(empty).count() == 0


def test_edit_distance():
    rnd = random.Random(9)
    for _ in range(2000):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert line_dedup.edit_distance(a, b) == row[-1]


def lines_brute(rows, similarity=0.8):
    forms = sorted({f for _, t, *_ in rows for f in line_dedup.normalised_lines(t or "") if f})
    groups = Groups(forms)
    for i, a in enumerate(forms):
        for b in forms[:i]:
            if line_dedup.alike(a.decode(), b.decode(), similarity):
                groups.join(a, b)
    keeper = {}
    for doc_id, text, *_ in rows:
        for f in filter(None, line_dedup.normalised_lines(text or "")):
            g = groups.of(f)
            if g not in keeper or keeper[g] is None or doc_id is not None and doc_id < keeper[g]:
                keeper[g] = doc_id
    out = []
    for doc_id, text, *_ in rows:
        seen, left = set(), []
        for line, f in zip((text or "").split("\n"), line_dedup.normalised_lines(text or "")):
            if f:
                g = groups.of(f)
                if keeper[g] != doc_id or g in seen:
                    continue
                seen.add(g)
            left.append(line)
        out.append((doc_id, "\n".join(left)))
    return out


def test_line_dedup(docs, rows, empty):
    got = line_dedup.dedup_lines(docs, removed_col="gone").collect()
    assert Counter((r.doc_id, r.text or "") for r in got) == Counter(lines_brute(rows))
    assert all(r.n_lines == "kept" for r in got)
    stay = line_dedup.without_repeated_lines(docs)
    assert stay.columns == docs.columns
    had = {r[0]: any(line_dedup.normalised_lines(r[1] or "")) for r in rows}
    want = Counter((i, t) for i, t in lines_brute(rows) if any(line_dedup.normalised_lines(t)) or not had[i])
    found = Counter((r.doc_id, r.text or "") for r in stay.collect())
    assert {k: v for k, v in found.items() if k[0] is not None} == {k: v for k, v in want.items() if k[0] is not None}
    assert line_dedup.without_repeated_lines(empty).count() == 0


def test_near_lines_make_one_group(spark):
    text = "the quick brown fox jumps over the lazy dog near the old stone bridge by the river while nobody watches it go"
    rows = [(i, "head %d\n%s" % (10**6 + i * 977, text.upper() if i == 1 else text + "!" * i)) for i in range(5)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got if "quick" in r.text.lower()) == [0]


def test_mix(docs, rows, empty):
    mixed = mixing.mix(docs)
    got = mixing.taken(mixed).collect()
    sizes, sources = defaultdict(int), {r[0]: r[3] for r in rows}
    for _, text, _, source, _ in rows:
        sizes[source] += len(words_of(text))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        for s in above or open_:
            target[s] = 2.0 * sizes[s] if above else share[s]
        rest -= sum(target[s] for s in above)
        open_ -= set(above) if above else open_
    by_source = defaultdict(int)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        if r.doc_id is not None:
            s = sources[r.doc_id]
            assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
    for r in mixed.collect():
        by_source[r.source] += sum(d.words for d in r.draws)
    assert by_source == {s: round(t) for s, t in target.items()}
    again = mixing.taken(mixing.mix(docs.repartition(5)))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))
    mixture = mixing.mixed_documents(docs, mixed, shard_col="to", place_col="at").collect()
    words = defaultdict(int)
    for r in mixture:
        words[r.source] += len(words_of(r.text))
        assert r.shard == "kept"
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in by_source.items() if n}
    assert mixing.taken(mixing.mix(empty)).count() == 0


def test_splitting_tree_deals_exact_counts(spark):
    counts = {1: 1000, 2: 37, 3: 0, 4: 2500}
    units = spark.createDataFrame(list(counts.items()), "rank int, units long")
    for shards in (1, 7, 16):
        leaves = mixing.splitting_tree(units, shards).collect()
        got, per_shard = defaultdict(list), defaultdict(int)
        for r in leaves:
            got[r["rank"]] += range(r["first"], r["first"] + r["n"])
            per_shard[r["shard"]] += r["n"]
        assert {k: sorted(v) for k, v in got.items()} == {k: list(range(n)) for k, n in counts.items() if n}
        assert max(per_shard.values()) - min(per_shard.values()) <= 4


def test_hypergeometric_law(spark):
    from math import comb
    sql = mixing.hypergeometric("40L", "15L", "12L", "u")
    got = Counter(r.x for r in spark.range(4000).selectExpr("(id + 0.5D) / 4000 as u").selectExpr(f"{sql} as x").collect())
    for x in range(13):
        assert abs(got[x] / 4000 - comb(15, x) * comb(25, 12 - x) / comb(40, 12)) < 2e-3


def test_token_ids_are_the_tokenizers_own(rows):
    odd = ["", "  a  b ", "a\n\nb", "x\n y", "it's he'll  ok", "<|endoftext|> hi <|endoftext|>", " a   b", "a\x1c b", "tab\tb c\t", "  ", "\n", "a \n",
           "é ü z", "a\0b c", "a b\u0085c d", "1 2 3a ...", " lead", "trail ", "漢字 かな", " x  y", "🙂 ok"]
    texts = odd + [t for _, t, *_ in rows if t]
    encoder = packing.Encoder(BYTE_BPE, 50)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_best_fit_fills_without_gaps():
    rnd = random.Random(10)
    for _ in range(300):
        capacity = rnd.randint(1, 30)
        counts = {rnd.randint(1, capacity): rnd.randint(1, 40) for _ in range(rnd.randint(0, 10))}
        held = defaultdict(list)
        for p in packing.best_fit(counts, capacity):
            for i in range(p.pieces):
                held[p.first + i // p.each].append((p.offset + i % p.each * p.length, p.length))
        assert sum(map(len, held.values())) == sum(counts.values())
        for pieces in held.values():
            ends = 0
            for start, length in sorted(pieces):
                assert start == ends
                ends += length
            assert ends <= capacity
        # as best-fit decreasing, item by item
        gaps = []
        for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            fit = min((g for g in gaps if g >= length), default=None)
            if fit is not None:
                gaps.remove(fit)
            gaps.append((capacity if fit is None else fit) - length)
        assert len(held) == len(gaps)


def test_packing(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 5)
    monkeypatch.setattr(packing, "BLOCK", 4)
    capacity = 256
    got = packing.best_fit_packing(packing.token_pieces(docs, BYTE_BPE, capacity, keep_ids=True), capacity).collect()
    encoder = packing.Encoder(BYTE_BPE, 10**6)
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for k in range(-(-len(ids) // capacity)):
            end = len(ids) - (-(-len(ids) // capacity) - 1 - k) * capacity
            part = np.array(ids[at:end], "<u4").tobytes()
            want[doc_id, k, at, end - at, zlib.crc32(part), part] += 1
            at = end
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        assert [o for o, _ in sorted(pieces)] == [sum(n for _, n in sorted(pieces)[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= capacity
    assert len(held) <= -(-sum(r.length for r in got) // capacity) * 1.05 + 1
    assert packing.best_fit_packing(packing.token_pieces(empty, BYTE_BPE, capacity), capacity).count() == 0


def repeats_brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        runs = []
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        kept = b"".join(d[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), len(d)]))
        out.append((len(d), len(d) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, gram, batches", [(400, 128, 4), (60, 20, 3)])
def test_repeated_strings_go(docs, rows, length, gram, batches):
    got = suffix_dedup.remove_repeats(docs, batches, length, gram).collect()
    want = Counter((r[0], *x) for r, x in zip(rows, repeats_brute([r[1] for r in rows], length)))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert any(r.n_removed for r in got)


def test_no_documents_no_repeats(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_levels_stay_logarithmic(spark):
    index = suffix_dedup.SuffixIndex()
    for i in range(6):
        index.add(spark.createDataFrame([(i % 2, i, i, 0, 0, 0)], suffix_dedup._NODE))
    assert [n for n, _ in index.levels] == [4, 1, 1]
    assert index.candidates().count() == 6


def test_restored_spellings():
    text = "you stupid idiot and moron are a worthless loser clown with pathetic trash and scum in the old town " * 30
    model = toxicity.log_probabilities(toxicity.trigram_counts(text).reshape(toxicity.SIZE, toxicity.SIZE, toxicity.SIZE).astype(float))
    restorer = toxicity.Restorer(model)
    for hidden, plain in {"1d10t": "idiot", "m o r o n": "moron", "st00pid": "stoopid", "stuuuupid": "stupid", "$cum": "scum", "w0rthle55": "worthless",
                          "cl0wn!": "clown", "p@thet1c": "pathetic", "l.o.s.e.r": "loser", "TRASH###": "trash", "the": "the"}.items():
        assert restorer.words(hidden) == [plain], hidden
    assert restorer.words("") == [] and restorer.words("12 34 --") == [] and len(restorer.words("x" * 500)) == 1


def test_toxicity(spark, empty):
    rnd = random.Random(11)
    vocabulary = ["w" + "".join(rnd.choice("aeioulmnrst") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 60))]
        toxic = i % 5 == 0
        if toxic:
            words.insert(rnd.randrange(len(words) + 1), rnd.choice(["grobnik", "grobnaks", "GROBNIK!", "gr0bnik", "grobbbnik", "g r o b n i k"]))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, None, None, None, None), (2001, "", None, None, None), (None, "grobnik", None, None, None), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, n_chars long")
    marks = spark.createDataFrame(labels + [labels[0], (None, 1, 1), (5000, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, marks).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert right >= 0.98 * len(held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert not any(r.predicted for r in got if r.doc_id in (2000, 2001))
    stay = toxicity.without_toxic(docs, marks)
    assert stay.columns == docs.columns and Counter(r.doc_id for r in stay.collect()) == Counter(r.doc_id for r in got if not r.predicted)
    # without labels nobody is toxic
    assert {r.score for r in toxicity.toxicity(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(empty, marks).count() == 0


def test_pipeline(spark, tmp_path_factory, rows):
    import corpus_pipeline
    from llm_helpers import SCHEMA

    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, folder)
        path = f"{folder}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if stage is not corpus_pipeline.packing:
            assert docs.columns == before.columns
    assert docs.count() > 0
    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == docs.columns and whole.count() == docs.count()
