"""Mixing sources to target weights, with DataFrame and SQL functions only.

Targets. Every source has a weight and a share of the mix in words; no target
may pass `cap` times its source's size, and what is cut off is shared out anew
by weight until no target is above. Sorted by cap over weight, the sources
that end at their cap are a prefix, so the fixed point needs two running sums
over the (few) sources.

Draws. A hash of the id deals a source's documents into blocks of about
BLOCK_ROWS rows: a fixed random order, cut into pieces, in which a hot source
is many blocks. A target of q words takes the whole source q div size times
and then its leading blocks up to the remaining words; the block where the
quota ends gives its leading documents, the last of them in part.

Splitting tree. The unit counts of all sources go from the root down to the
output shards: a node halves its shards, and the number of each source's
units that go left is drawn from the multivariate hypergeometric distribution
(source after source, inverse distribution function, randomness from a hash of
seed and node). Counts are exact, every shard gets an equal share of units,
and the shards' unit ranges are disjoint. Within a shard, documents are
ordered by a hash. Reruns agree.

Defined results: null text has size 0; null is a source of its own, last in
order; a source without words has target 0; an empty table gives no rows;
repeated rows are drawn each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendloom.llm.common import WORD, saved

BLOCK_ROWS = 2048
SHARD_WORDS = 4_000_000
SEED = 7


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Add (rank, target) to one row per source with columns source and words."""
    listed = F.array(*[F.lit(float(w)) for w in weights])
    everything = Window.partitionBy()
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = (ranked.withColumn("weight", F.element_at(listed, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
              .withColumn("limit", F.lit(float(cap)) * F.col("words"))
              .withColumn("total", F.lit(float(share)) * F.sum("words").over(everything)))
    upto = Window.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - (F.sum("limit").over(upto) - F.col("limit"))) / F.sum("weight").over(onward)
    at_cap = ranked.withColumn("capped", F.col("limit") <= level * F.col("weight"))
    rest = F.col("total") - F.sum(F.when(F.col("capped"), F.col("limit")).otherwise(0.0)).over(everything)
    among = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("weight") * rest / among))
    return at_cap.withColumn("target", target).drop("weight", "limit", "total", "capped")


def _ln_factorial(x: str) -> str:
    """ln(x!) by Stirling's series at x + 9, taken back by eight factors."""
    z = f"(({x}) + 9.0D)"
    back = " + ".join(f"ln(({x}) + {i}.0D)" for i in range(1, 9))
    return f"(({z} - 0.5D) * ln({z}) - {z} + 0.91893853320467274178D + 1 / (12 * {z}) - 1 / (360 * {z} * {z} * {z}) - ({back}))"


def _ln_choose(n: str, k: str) -> str:
    return f"({_ln_factorial(n)} - {_ln_factorial(k)} - {_ln_factorial(f'{n} - {k}')})"


def hypergeometric(total: str, good: str, drawn: str, uniform: str) -> str:
    """SQL for the inverse distribution function of the hypergeometric law.

    Of `total` units, `good` are of one kind and `drawn` are taken; `uniform`
    is in [0, 1). The walk covers twelve standard deviations around the mean,
    beyond which nothing is left to double precision.
    """
    low, high = f"greatest(0L, {drawn} + {good} - {total})", f"least({drawn}, {good})"
    mean = f"({drawn} * 1.0D * {good} / greatest({total}, 1L))"
    reach = f"(12 * sqrt({mean}) + 12)"
    first = f"greatest({low}, cast(floor({mean} - {reach}) as long))"
    last = f"greatest({first}, least({high}, cast(ceil({mean} + {reach}) as long)))"
    start = (f"exp({_ln_choose(good, 'a')} + {_ln_choose(f'({total} - {good})', f'({drawn} - a)')} - {_ln_choose(total, drawn)})")
    # s.p: probability of s.x, s.c: probability of at most s.x; x stops where c passes the uniform
    walk = (f"aggregate(sequence(a + 1, z), named_struct('p', p, 'c', p, 'x', a), (s, x) -> if(s.c > {uniform}, s, "
            f"named_struct('p', s.p * ({good} - x + 1) / x * ({drawn} - x + 1) / ({total} - {good} - {drawn} + x), "
            f"'c', s.c + s.p * ({good} - x + 1) / x * ({drawn} - x + 1) / ({total} - {good} - {drawn} + x), 'x', x)), s -> s.x)")
    walked = f"element_at(transform(array({start}), p -> if(a >= z, a, {walk})), 1)"
    bound = f"element_at(transform(array({first}), a -> element_at(transform(array({last}), z -> {walked}), 1)), 1)"
    return f"if({low} >= {high}, {high}, {bound})"


def splitting_tree(units: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(shard, rank, first, n): which units of each source go to which shard.

    `units` has one row per source: rank and units (how many there are).
    """
    node = (units.agg(F.sort_array(F.collect_list(F.struct("rank", F.col("units").alias("n"), F.lit(0).cast("long").alias("first")))).alias("s"))
            .filter(F.size("s") > 0).select(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "s"))
    uniform = f"(shiftrightunsigned(xxhash64({seed}L, low, high, e.rank), 11) / 9007199254740992.0D)"
    draw = hypergeometric("acc.total", "e.n", "acc.need", uniform)
    left = ("aggregate(s, named_struct('total', total, 'need', need, 'out', cast(array() as array<bigint>)), (acc, e) -> "
            f"element_at(transform(array({draw}), x -> named_struct('total', acc.total - e.n, 'need', acc.need - x, 'out', array_append(acc.out, x))), 1), acc -> acc.out)")
    for _ in range(max(0, shards - 1).bit_length()):
        node = (node.withColumn("total", F.expr("aggregate(s, 0L, (t, e) -> t + e.n)"))
                .withColumn("mid", F.expr("(low + high + 1) div 2"))
                .withColumn("need", F.expr("cast(round(total * (mid - low) / (high - low)) as long)"))
                .withColumn("left", F.expr(f"if(high - low = 1, transform(s, e -> e.n), {left})")))
        halves = F.expr(
            "filter(array(named_struct('low', low, 'high', if(high - low = 1, high, mid), 's', transform(s, (e, i) -> named_struct('rank', e.rank, 'n', left[i], 'first', e.first))), "
            "named_struct('low', mid, 'high', high, 's', transform(s, (e, i) -> named_struct('rank', e.rank, 'n', e.n - left[i], 'first', e.first + left[i])))), h -> h.low < h.high)")
        node = node.select(F.explode(halves).alias("h")).select("h.low", "h.high", "h.s")
    return node.select(F.col("low").alias("shard"), F.explode("s").alias("e")).select("shard", "e.rank", "e.first", "e.n").filter("n > 0")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: its size, its source's size and target, its draws.

    Columns: doc_id, text_hash, source, size, source_size, target, draws. A
    draw is (shard, place, words): the output shard, the document's place in
    the shard's order, and how many of its leading words it gives (all but in
    the last document of a quota).
    """
    rows = saved(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                             F.xxhash64(F.col(text_col)).alias("text_hash")), "sizes")
    sources = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    sources = targets(sources, weights, share, cap).withColumn("blocks", F.expr(f"(n + {BLOCK_ROWS - 1}) div {BLOCK_ROWS}"))
    sources = saved(sources.withColumn("quota", F.round("target").cast("long"))
                    .withColumn("passes", F.expr("if(words = 0, 0L, quota div words)"))
                    .withColumn("over", F.expr("if(words = 0, 0L, quota % words)")), "sources")
    keyed = (rows.join(sources.withColumnRenamed("source", "name").withColumnRenamed("words", "source_size"), F.col("source").eqNullSafe(F.col("name")))
             .withColumn("key", F.xxhash64("doc_id", F.lit(seed)))
             .withColumn("block", F.expr("pmod(key, blocks)")))
    blocks = keyed.groupBy("rank", "block", "passes", "over", "blocks").agg(F.sum("size").alias("block_words"))
    before = F.sum("block_words").over(Window.partitionBy("rank").orderBy("block")) - F.col("block_words")
    blocks = saved(blocks.withColumn("extra", F.least(F.greatest(F.col("over") - before, F.lit(0)), F.col("block_words")))
                   .withColumn("in_part", (before < F.col("over")).cast("long")), "blocks")
    # empty block numbers (a small source) are units that hold nothing
    units = blocks.groupBy("rank", "passes", "blocks").agg(F.coalesce(F.max(F.when(F.col("in_part") == 1, F.col("block") + 1)), F.lit(0)).alias("more"))
    units = units.select("rank", F.expr("passes * blocks + more").alias("units"))
    words = sources.agg(F.sum("quota")).first()[0] or 0
    tree = splitting_tree(units, max(1, -(-words // SHARD_WORDS)), seed)
    per_block = F.col("blocks")
    dealt = (tree.withColumn("unit", F.explode(F.expr("sequence(first, first + n - 1)")))
             .join(sources.select("rank", "blocks", "passes"), "rank")
             .select("rank", (F.col("unit") % per_block).alias("block"), F.expr("unit div blocks").alias("epoch"), "shard", "passes")
             .groupBy("rank", "block").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("units")))
    placed = blocks.select("rank", "block", "extra").join(dealt, ["rank", "block"], "left")
    in_block = Window.partitionBy("rank", "block").orderBy("key", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    rows = keyed.withColumn("before", F.sum("size").over(in_block) - F.col("size")).join(placed, ["rank", "block"])
    draws = F.expr("transform(coalesce(units, cast(array() as array<struct<epoch: bigint, shard: bigint>>)), u -> named_struct("
                   f"'shard', u.shard, 'place', xxhash64({seed}L, key, u.epoch), "
                   "'words', if(u.epoch < passes, size, least(greatest(extra - before, 0L), size))))")
    return rows.select("doc_id", "text_hash", "source", "size", "source_size", "target", F.filter(draws, lambda d: d.words > 0).alias("draws"))


def taken(mixed: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, n_draws): the words the mix takes of each document."""
    total = F.aggregate("draws", F.lit(0).cast("long"), lambda t, d: t + d.words)
    return mixed.select("doc_id", "size", "source_size", "target", total.alias("taken"), F.size("draws").cast("long").alias("n_draws"))


def mixed_documents(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_col: str = "shard",
                    place_col: str = "place") -> DataFrame:
    """The mix itself: a row of `docs` for each draw, with its shard and place.

    A draw of only some words keeps the text up to the end of the last of
    them. To write the shards, repartition by the shard and sort each
    partition by the place.
    """
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("own")
    left = docs.select(own, F.col(id_col).alias("doc_id"), n_words(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    # equal rows are told apart by number; which is which does not matter
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("size", "text_hash"))
    right = mixed.withColumn("number", number).select(F.col("doc_id").alias("drawn_id"), F.col("number").alias("drawn_number"), "draws")
    both = left.withColumn("number", number).join(right, F.col("doc_id").eqNullSafe(F.col("drawn_id")) & (F.col("number") == F.col("drawn_number")))
    drawn = both.select("own", "size", F.explode("draws").alias("draw"))
    # only the one text that a source cuts is split: after each word, so n parts end with the n-th word
    text = F.col("own")[text_col]
    parts = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    head = F.array_join(F.slice(parts, F.lit(1), F.col("draw.words").cast("int")), "")
    cut = F.when(F.col("draw.words") == F.col("size"), text).otherwise(head)
    return drawn.select(*[cut.alias(c) if c == text_col else F.col("own")[c].alias(c) for c in docs.columns],
                        F.col("draw.shard").alias(shard_col), F.col("draw.place").alias(place_col))
