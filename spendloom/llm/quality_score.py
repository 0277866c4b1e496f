"""Quality scores: a Gaussian kernel over document statistics, approximated by random Fourier features.

Every text becomes a short vector of statistics (shares of character classes,
word and line repetition, the worst line's symbols and capitals, and so on).
Standardised and mapped to `cos(W x + b)` with normal `W`, inner products of
these features approximate a Gaussian kernel. Each task sums its share of the
normal equations of a ridge regression on the labels; Spark adds the shares.
Two folds of the training rows are summed apart: each fold is scored by the
weights of the other one, and these scores are calibrated by isotonic
regression (pool adjacent violators over binned scores). The final weights are
those of both folds.

All labelled training rows are used. Features are rounded to multiples of
2**-12 and statistics to 2**-16, so their sums are whole numbers, exact in any
order: reruns fit the same weights whatever the partitions, and scores agree
up to the rounding of one dot product. What reaches the driver is bounded by the
number of features and of score bins, whatever the table's size.

Defined results: null text is empty text, which has a vector of zeros and a
score like any other; repeated rows score alike; a null id is never labelled
and not held out. Several labels of one id count as 1 if one of them is 1;
labels other than 0 and 1 are ignored. Without any usable label all documents
score 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import by_batch, saved, texts, utf8

STATISTICS = ("words", "mean_word", "longest_word", "distinct_words", "next_equal", "commonest_word", "lines", "mean_line",
              "equal_lines", "upper", "lower", "digits", "beyond_ascii", "sentence_ends", "commas", "symbols", "bars", "spaces",
              "entropy", "worst_line_symbols", "worst_line_upper", "mixed_ends")

#: Random features, their seed, and the kernel's width in units of sqrt(number of statistics).
FEATURES, SEED, WIDTH = 256, 7, 1.2
RIDGE = 1.0
FEATURE_STEP, STATISTIC_STEP = 2.0**-12, 2.0**-16
FARTHEST = 6.0  # standard deviations; statistics beyond count as this far
#: Scores are binned in steps of this size between the ends before calibration.
BIN, LEAST, MOST = 2.0**-10, -1.0, 2.0
#: Share of the score that keeps the order of documents within a calibrated step.
ORDER_SHARE = 1e-3

_SYMBOLS = b"#*$%&|<>@^~_=+\\{}[]`/!"


def _flags(members: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(members)] = 1
    return table


_UPPER, _LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
_CLASSES = np.array([_flags(m) for m in (_UPPER, _LOWER, b"0123456789", bytes(range(0x80, 0x100)), b".!?", b",;:", _SYMBOLS, b"|", b" \t\r\v\f")])
_IS_SYMBOL, _IS_UPPER = _flags(_SYMBOLS).astype(np.int32), _flags(_UPPER).astype(np.int32)
_ENDS = _flags(_SYMBOLS).astype(bool)


def statistics(text: str) -> np.ndarray:
    """The vector of STATISTICS of a whole text; zeros where it has no words."""
    data = utf8(text)
    words = data.split()
    if not words:
        return np.zeros(len(STATISTICS))
    codes = np.frombuffer(data, np.uint8)
    counts = np.bincount(codes, minlength=256)
    shares = _CLASSES @ counts / len(codes)
    found = counts[counts > 0] / len(codes)
    ids: dict[bytes, int] = {}
    numbers = np.array([ids.setdefault(w, len(ids)) for w in words])
    sizes = np.array([len(w) for w in words])
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    start = np.concatenate([[0], np.flatnonzero(codes == 10) + 1])
    start = start[start < len(codes)]
    length = np.diff(np.append(start, len(codes)))
    long_enough = length >= min(20, length.max())
    symbols, upper = (np.add.reduceat(kind[codes], start) / length for kind in (_IS_SYMBOL, _IS_UPPER))
    out = (
        np.log1p(len(words)), np.log1p(sizes.mean()), np.log1p(sizes.max()), len(ids) / len(words),
        np.count_nonzero(numbers[1:] == numbers[:-1]) / len(words), np.bincount(numbers).max() / len(words),
        np.log1p(len(lines)), np.log1p(len(codes) / len(lines)), 1 - len(set(lines)) / len(lines), *shares,
        -(found * np.log(found)).sum(), symbols[long_enough].max(), upper[long_enough].max(),
        np.mean([_ENDS[w[-1]] for w in words]),
    )
    return np.array(out)


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<float>) of (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t) for t in batch.column("text").to_pylist()], np.float32)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(rows)], names=["doc_id", "x"])

    return by_batch(docs, run, f"doc_id {kind}, x array<float>")


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.ravel())


def _rows(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class RandomFeatures:
    """Standardise, then cos(W x + b): inner products approximate a Gaussian kernel."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, size: int = FEATURES, seed: int = SEED, width: float = WIDTH):
        rnd = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-6, spread, 1.0)
        self.w = rnd.standard_normal((len(mean), size)) / (width * np.sqrt(len(mean)))
        self.b = rnd.uniform(0, 2 * np.pi, size)

    def of(self, x: np.ndarray) -> np.ndarray:
        """Features of the rows of `x` and a constant, as multiples of FEATURE_STEP."""
        z = np.clip((x - self.mean) / self.spread, -FARTHEST, FARTHEST)
        z = np.round(np.cos(z @ self.w + self.b) * np.sqrt(2) / FEATURE_STEP) * FEATURE_STEP
        return np.hstack([z, np.ones((len(z), 1))])


def _partition_sums(df: DataFrame, fn, schema: str) -> list:
    """Rows (keys..., value) of `fn(x, label, fold)` summed within each task, then over tasks, exactly."""
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = fn(_rows(batch.column("x")), batch.column("label").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([*(pa.array(i.astype(np.int32)) for i in at), pa.array(total[at])], names=names)

    return df.mapInArrow(run, schema).groupBy(*names[:-1]).agg(F.sum(names[-1]).alias(names[-1])).collect()


def moments(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each statistic over the labelled rows."""
    size = len(STATISTICS)

    def part(x: np.ndarray, label: np.ndarray, fold: np.ndarray) -> np.ndarray:
        whole = np.round(np.vstack([np.ones((1, len(x))), x.T, x.T**2]) / STATISTIC_STEP).astype(np.int64)
        return whole.sum(1)

    sums = np.zeros(2 * size + 1)
    for at, total in _partition_sums(labelled, part, "i int, total long"):
        sums[at] = total * STATISTIC_STEP
    n = max(sums[0], 1.0)
    mean = sums[1 : size + 1] / n
    return mean, np.sqrt(np.maximum(sums[size + 1 :] / n - mean**2, 0))


def normal_equations(labelled: DataFrame, features: RandomFeatures) -> np.ndarray:
    """Sums of products of features, constant and label, one matrix for each fold."""
    size = len(features.b) + 2

    def part(x: np.ndarray, label: np.ndarray, fold: np.ndarray) -> np.ndarray:
        out = np.zeros((2, size, size), np.int64)
        rows = np.hstack([features.of(x), label[:, None]])
        for k in (0, 1):
            own = rows[fold == k]
            # products are multiples of FEATURE_STEP ** 2: their sums are exact
            out[k] = np.triu(np.round(own.T @ own / FEATURE_STEP**2).astype(np.int64))
        return out

    sums = np.zeros((2, size, size))
    for fold, i, j, total in _partition_sums(labelled, part, "fold int, i int, j int, total long"):
        sums[fold, i, j] = sums[fold, j, i] = total * FEATURE_STEP**2
    return sums


def ridge(sums: np.ndarray) -> np.ndarray:
    """Weights of features and constant from summed normal equations."""
    a, b = sums[:-1, :-1], sums[:-1, -1]
    weight = np.full(len(a), RIDGE)
    weight[-1] = 1e-9  # the constant is free
    return np.linalg.solve(a + np.diag(weight), b)


def pool_adjacent(x: np.ndarray, n: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of shares `ones / n` on increasing `x`: the steps' centres and shares."""
    blocks: list[list[float]] = []  # rows, ones, sum of x
    for at, rows, hits in zip(x.tolist(), n.tolist(), ones.tolist()):
        blocks.append([rows, hits, at * rows])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


class Model:
    """Features, weights and calibration steps: all that scoring needs."""

    def __init__(self, features: RandomFeatures, weights: np.ndarray, centres: np.ndarray, shares: np.ndarray):
        self.features, self.weights, self.centres, self.shares = features, weights, centres, shares

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.features.of(x) @ self.weights
        steps = np.interp(raw, self.centres, self.shares)
        return np.clip((1 - ORDER_SHARE) * steps + ORDER_SHARE / (1 + np.exp(np.clip(-4 * (raw - 0.5), -30, 30))), 0, 1)


def fit(labelled: DataFrame) -> Model | None:
    """Fit on (x, label, fold) rows; None if there are none."""
    features = RandomFeatures(*moments(labelled))
    sums = normal_equations(labelled, features)
    rows = sums[:, -2, -2]
    if not rows.sum():
        return None
    both = ridge(sums.sum(0))
    other = [ridge(sums[1 - k]) if rows[1 - k] else both for k in (0, 1)]
    n_bins = int((MOST - LEAST) / BIN) + 1

    def part(x: np.ndarray, label: np.ndarray, fold: np.ndarray) -> np.ndarray:
        z = features.of(x)
        raw = np.where(fold == 0, z @ other[0], z @ other[1])
        bins = np.clip(np.round((raw - LEAST) / BIN), 0, n_bins - 1).astype(np.int64)
        return np.array([np.bincount(bins[label == k], minlength=n_bins) for k in (0, 1)])

    counts = np.zeros((2, n_bins))
    for label, at, total in _partition_sums(labelled, part, "label int, bin int, total long"):
        counts[label, at] = total
    used = np.flatnonzero(counts.sum(0))
    return Model(features, both, *pool_adjacent(LEAST + used * BIN, counts.sum(0)[used], counts[1, used]))


def training_rows(stats: DataFrame, labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    """(x, label, fold) of the rows outside the held-out third; the folds are the other two remainders."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marks = marks.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).filter(remainder != 1)
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label"))
    return stats.join(marks, "doc_id").select("x", "label", (remainder / 2).cast("int").alias("fold"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of `docs`."""
    stats = saved(document_statistics(texts(docs, id_col, text_col)), "statistics")
    model = fit(saved(training_rows(stats, labels, label_col, id_col), "labelled"))
    kind = stats.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model.score(_rows(batch.column("x"))) if model else np.full(batch.num_rows, 0.5)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = by_batch(stats, run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
