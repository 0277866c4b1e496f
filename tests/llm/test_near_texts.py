"""Near fingerprints of edited texts against all pairs."""

import random

from spendloom.llm import fingerprints as fp
from spendloom.llm.common import word_hashes


def test_edited_texts_are_near(spark, monkeypatch):
    rnd = random.Random(31)
    texts = []
    for _ in range(60):
        words = ["w%d" % rnd.randrange(10**6) for _ in range(rnd.choice([60, 100, 300]))]
        texts.append(words)
        for share in (0.01, 0.03, 0.06):
            copy = list(words)
            for k in rnd.sample(range(len(copy)), max(1, int(share * len(copy)))):
                copy[k] = "x%d" % rnd.randrange(10**6)
            texts.append(copy)
    prints = [fp.fingerprint(word_hashes(" ".join(t).encode())).hex() for t in texts]
    df = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fingerprint string")
    near = {a: sum((int(a, 16) ^ int(b, 16)).bit_count() <= fp.NEAR_BITS for b in prints) - 1 for a in prints[::4]}
    assert sum(near.values()) > 100
    monkeypatch.setattr(fp, "SCAN_ROWS", 25)  # several passes
    monkeypatch.setattr(fp, "_SCAN_TILE", (3, 7))
    assert {r.fingerprint: r.n_near for r in fp.near_counts(df, "doc_id % 4 = 0", fp.NEAR_BITS).collect()} == near


def test_query_counts_near_copies(spark, tmp_path):
    from spendloom.llm.queries import op2_fingerprints

    rnd = random.Random(33)
    words = ["w%d" % rnd.randrange(10**6) for _ in range(100)]
    rows = [(i, " ".join(words[:50] + ["edit%d" % i] + words[51:])) for i in range(8)] + [(20, "nothing like the others")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_near for r in op2_fingerprints(spark, str(tmp_path)).collect()}
    assert got[0] == 7 and got[20] == 0
