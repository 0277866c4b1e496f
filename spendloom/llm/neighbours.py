"""Every document beside the one that follows it in descending id order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendloom.llm.common import saved

Pairs = Callable[[list, list[str], list[str]], pa.RecordBatch]


def with_next(docs: DataFrame, fn: Pairs, schema: str) -> DataFrame:
    """`fn(ids, texts, next_texts)` over all documents in descending id order.

    `docs` has (doc_id long, text string); null ids come last, equal ids are
    ordered by text, and the first document follows the last one. `schema`
    starts with `doc_id long`; `fn` returns an Arrow batch of it.

    The texts are range-partitioned once and every task streams its sorted
    share with one row of look-behind. A task cannot see the next task's first
    row, so it passes on its own first and last row; these few rows are joined
    by partition number afterwards.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    ranged = docs.select("doc_id", "text").repartitionByRange(order[0]).sortWithinPartitions(*order)
    names = [c.split()[0] for c in schema.split(",")]
    inner = f"part int, edge string, text string, {schema}"

    def edge(part: int, kind: str, doc_id, text: str, like: pa.Schema) -> pa.RecordBatch:
        columns = [pa.array([part], pa.int32()), pa.array([kind]), pa.array([text], pa.string()), pa.array([doc_id], pa.int64())]
        columns += [pa.nulls(1, like.field(c).type) for c in names[1:]]
        return pa.RecordBatch.from_arrays(columns, names=["part", "edge", "text", *names])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, held = TaskContext.get().partitionId(), None, None
        like = fn([], [], []).schema
        for batch in batches:
            ids, own = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if not ids:
                continue
            first = first or (ids[0], own[0])
            following = own if held is not None else own[1:]
            if held is not None:
                ids, own = [held[0], *ids], [held[1], *own]
            held = (ids[-1], own[-1])
            done = fn(ids[:-1], own[:-1], following)
            n = done.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), *done.columns], names=["part", "edge", "text", *names])
        if held is not None:
            yield edge(part, "first", *first, like)
            yield edge(part, "last", *held, like)

    done = saved(ranged.mapInArrow(stream, inner), "with-next")
    firsts = done.filter("edge = 'first'").select("part", F.col("text").alias("following"))
    parts = firsts.select("part")  # one row per task
    after = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next"))
    lasts = done.filter("edge = 'last'").select("part", "doc_id", "text").join(after, "part")
    seams = lasts.join(firsts.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "following")

    def seam(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")))

    return done.filter("edge is null").select(*names).unionByName(seams.mapInArrow(seam, schema))
