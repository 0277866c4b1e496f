"""Helpers shared by the training-data operators.

Text columns are read as "null means empty" everywhere. Operators select the
columns they need under private names first, so extra columns of the input,
whatever they are called, never clash with intermediate ones.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendloom.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared checkpoint folder as Parquet and read back.

    Cuts the lineage: a lost executor never recomputes what lies before. The
    folder goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete what `saved` wrote for these frames; nothing that is still to run may read them."""
    for df in frames:
        spark = df.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cleaned(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of the steps before, which nothing reads any more.

    It does so when the driver's garbage collector finds their plans unused;
    on a driver with much memory that may be long after the disks are full.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null text as empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def by_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, most_bytes: int | None = None) -> DataFrame:
    """Apply `fn` to every Arrow batch; a batch in, at most one batch out.

    With `most_bytes` a larger batch is handed on in slices of about that size,
    which bounds what `fn` holds at once however many rows Spark puts in a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most_bytes):
            out = fn(part)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int | None) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about `most_bytes`, or the batches that hold rows."""
    for batch in batches:
        rows = batch.num_rows
        step = max(1, rows * most_bytes // max(1, batch.nbytes)) if most_bytes else max(1, rows)
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 text: runs of anything but space and \\t to \\r."""
    return hashes_of(data.split())


def hashes_of(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


#: Rows of one or two numbers up to which a side is broadcast (about 10 MB).
BROADCAST_ROWS = 400_000


def semi_join(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of `df` whose `key` is in the column `key` of `keys`.

    The distinct keys are written and counted; up to BROADCAST_ROWS they are
    broadcast, so `df` is not shuffled, and beyond that joined plainly.
    """
    keys = saved(keys.select(key).distinct(), "keys")
    return df.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, key, "left_semi")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd multipliers of the words of a shingle, from a Weyl sequence.
_ODD = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1) & MASK) | 1) for i in range(16)]


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the `width`-word windows (16 words at most); fewer words make one window; none make none."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    out = words[: n - width + 1] * _ODD[0]
    for i in range(1, width):
        out += words[i : n - width + 1 + i] * _ODD[i]
    return mix64(out + np.uint64(width))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of an edge list (a, b) of longs.

    Returns (id, component) for every id on an edge; `component` is the
    smallest id of its component. Rounds of "every node tells its neighbours
    the smallest id it sees" (large star, then small star) until nothing
    changes: a logarithmic number of rounds, every round an aggregation with
    map-side combine and a join, written to the shared folder. Hubs are no
    hot task: the smallest neighbour is a partial minimum and the join is one
    that Spark can split.
    """
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), label)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # large star: neighbours above a node link to the smallest id around it
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: a node and its smaller neighbours link to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        last, edges = edges, saved(small.filter("a <> b").unionByName(low.select("a", F.col("low").alias("b"))).distinct(), label)
        discard(last)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).collect()[0]
        if (now.n, now.h) == before:
            break
        before = (now.n, now.h)
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def linked_groups(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame],
                  may_link: Callable[[Column, Column], Column] = lambda x, y: F.lit(True),
                  refine: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
                  rest: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components (id, component) of the verified links among keys that share a bucket.

    `buckets` has (sig, key, facts): `facts` is a struct of what is known of a
    key; the key with the smallest facts is a bucket's centre. `may_link` is a
    cheap necessary condition on two facts. `verify` gets distinct pairs
    (a, b), a < b, and returns (a, b, links).

    Pairs are never all made at once: each key is first compared with one
    centre, then with the centre of each of its buckets; after that only keys
    that share a bucket, may link and are still in different components are
    paired. A group of near copies costs about one comparison a key, and every
    link between components is found. For the last step, `refine` may turn the
    keys that are left (key, component) into sharper facts (key, facts) and
    pairs (a, b) to compare whatever the facts say. Where keys can link without
    a common bucket, `rest` takes the last step's place: it gets the components
    (id, component) so far and returns the links (a, b) among them.
    """
    whole = Window.partitionBy("sig")
    centre = F.min(F.struct("facts", "key")).over(whole)
    buckets = buckets.withColumn("centre", centre).withColumn("last", F.max(F.struct("facts", "key")).over(whole))
    buckets = saved(buckets.filter("centre <> last").drop("last"), "buckets")
    near = buckets.filter(F.col("key") != F.col("centre.key")).filter(may_link(F.col("facts"), F.col("centre.facts")))
    pair = F.least("key", "centre.key").alias("a"), F.greatest("key", "centre.key").alias("b")
    stars = saved(near.select("key", "centre", *pair).distinct(), "stars")
    first = stars.groupBy("key").agg(F.min("centre").alias("centre")).select(*pair).distinct()
    seen = saved(verify(first), "verified")
    group = components(seen.filter("links").select("a", "b"))
    steps = [lambda: _apart(stars.select("a", "b").distinct(), group)]
    if not rest:
        steps.append(lambda: _bucket_pairs(buckets, group, may_link, refine))
    for pairs in steps:
        more = saved(verify(pairs().join(seen.select("a", "b"), ["a", "b"], "left_anti")), "verified")
        seen = seen.unionByName(more)
        group = components(seen.filter("links").select("a", "b"))
        cleaned(buckets)
    discard(buckets, stars)
    if rest:
        group = components(seen.filter("links").select("a", "b").unionByName(rest(group)))
    return group


def _apart(pairs: DataFrame, group: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends are in different components so far."""
    return (pairs.join(group.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
            .join(group.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
            .filter("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b"))


def _bucket_pairs(buckets: DataFrame, group: DataFrame, may_link: Callable[[Column, Column], Column],
                  refine: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None) -> DataFrame:
    """Pairs of keys that share a bucket but no component; a bucket within one component is left out first."""
    named = buckets.select("sig", "key", "facts").join(group.select(F.col("id").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    whole = Window.partitionBy("sig")
    apart = named.withColumn("low", F.min("component").over(whole)).withColumn("high", F.max("component").over(whole)).filter("low <> high")
    apart, more = saved(apart.drop("low", "high"), "apart"), None
    if refine:
        facts, more = refine(saved(apart.select("key", "component").distinct(), "apart-keys"))
        apart = apart.drop("facts").join(facts, "key")
    left = apart.select("sig", F.col("key").alias("a"), F.col("component").alias("ca"), F.col("facts").alias("x"))
    right = apart.select(F.col("sig").alias("sig2"), F.col("key").alias("b"), F.col("component").alias("cb"), F.col("facts").alias("y"))
    # the conditions are part of the join, so pairs that cannot link are no rows
    matched = (F.col("sig") == F.col("sig2")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & may_link(F.col("x"), F.col("y"))
    pairs = left.join(right, matched).select("a", "b")
    return (pairs.unionByName(more) if more else pairs).distinct()
