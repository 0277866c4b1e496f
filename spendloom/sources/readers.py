"""Readers: expenditure sheets, extracted tables, statement text and CSV.

Row order is data. Spark says in which split of which file a line stands and
counts lines inside a split, but another scan of the same files may be split
differently (other executors, other settings), so positions of two scans must
not be compared. The lines are therefore read from their files once, written
to the shared scratch folder with split and place, and everything else (header
lines, blank lines, rows) reads the written lines. Counting the lines of each
split turns places into line numbers of the file: the same numbers, however
the files were split, without a step that sees all lines of a file.

Columns are found by caption, and every file has its own header line: files
with other column orders can be read together. The header lines and the lines
that end a statement are few; they are joined to their file's rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendloom.functions.scalars import WS, clean_amount, parse_day_month_yy, py_strip
from spendloom.operators.rank import written
from spendloom.schema import (OPENING_BALANCE_PREFIX, RAW_ROWS_SCHEMA,
                              SHEET_SCHEMA, STATEMENT_META_KEYS)

ORDER_COLUMNS = ["source_file", "line_no"]
#: Files, or splits of files, up to which their few facts are broadcast.
BROADCAST_FILES = 10_000
BOM = "\ufeff"


def numbered_lines(spark: SparkSession, path: str, **marks: Column) -> DataFrame:
    """All lines of text files: ``source_file``, ``line_no`` (0, 1... in each file), ``line`` and ``marks``.

    A trailing carriage return is not part of the line. ``marks`` are columns
    over ``line``, evaluated in the one scan of the files. The lines are
    written while this function runs; the frame reads what was written.
    """
    raw = spark.read.text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("__block"),
                       F.monotonically_increasing_id().alias("__at"), F.regexp_replace("value", r"\r$", "").alias("line"))
    lines = written(lines.select("*", *[m.alias(name) for name, m in marks.items()]), "lines")
    # a split is read by one task from its first line to its last
    splits = lines.groupBy("source_file", "__block").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("source_file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(splits.select("source_file", "__block", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__start")), "line-splits")
    rows = _per_file(lines, starts, ["source_file", "__block"])
    return rows.select("source_file", (F.col("__at") + F.col("__start")).alias("line_no"), "line", *marks)


def _per_file(rows: DataFrame, files: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Join each file's few facts to its rows; broadcast while the files are few.

    Beyond that, a join on the file that Spark can split where one file is large.
    """
    return rows.join(F.broadcast(files) if files.count() <= BROADCAST_FILES else files, key, how)


# ---------------------------------------------------------------------------
# CSV with captions
# ---------------------------------------------------------------------------

def _csv_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(the lines that are not blank, the first of them in each file as ``at`` and ``header``)."""
    lines = numbered_lines(spark, path, is_blank=py_strip("line") == "").where("not is_blank").drop("is_blank")
    first = lines.groupBy("source_file").agg(F.min("line_no").alias("at"), F.min_by("line", "line_no").alias("header"))
    return lines, written(first.withColumn("header", F.regexp_replace("header", f"^{BOM}", "")), "csv-headers")


def _cells(line: str, width: int) -> Column:
    """The fields of a CSV line as an array of at least their number."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    return F.transform(F.array(F.from_csv(line, schema)), lambda f: F.array(*[f[f"c{i}"] for i in range(width)]))[0]


def _by_caption(lines: DataFrame, first: DataFrame, captions: Mapping[str, str]) -> DataFrame:
    width = first.agg(F.max(F.size(F.split("header", ",", -1)))).first()[0] or 1
    heads = first.withColumn("heads", F.transform(_cells("header", width), py_strip))
    heads = heads.select("source_file", "at", *[F.array_position("heads", caption).cast("int").alias(f"at_{i}") for i, caption in enumerate(captions.values())])
    rows = _per_file(lines, heads, "source_file").where(F.col("line_no") > F.col("at")).withColumn("cells", _cells("line", width))
    return rows.select(*ORDER_COLUMNS, *[F.when(F.col(f"at_{i}") > 0, F.get("cells", F.col(f"at_{i}") - 1)).alias(name) for i, name in enumerate(captions)])


def captioned_csv(spark: SparkSession, path: str, captions: Mapping[str, str] | None = None) -> DataFrame:
    """CSV files as text columns found by caption, each file by its own header.

    ``captions`` maps output names to captions, compared after stripping
    white space and a byte order mark; without it every caption of any file
    is a column, named and ordered as first seen (files by name). A caption
    that a file lacks gives NULL. The header is a file's first line that is not
    blank; blank lines are skipped; a quoted field may hold commas but no line
    break. The columns ``source_file`` and ``line_no`` come first.
    """
    lines, first = _csv_lines(spark, path)
    if captions is None:
        width = first.agg(F.max(F.size(F.split("header", ",", -1)))).first()[0] or 1
        seen = first.select("source_file", F.posexplode(F.transform(_cells("header", width), py_strip)).alias("pos", "caption"))
        seen = seen.where("caption <> ''").groupBy("caption").agg(F.min(F.struct("source_file", "pos")).alias("place"))
        captions = {r.caption: r.caption for r in seen.orderBy("place").select("caption").collect()}  # as many as there are columns
    return _by_caption(lines, first, captions)


# ---------------------------------------------------------------------------
# S1 sheet
# ---------------------------------------------------------------------------

#: What a column of text may be, the narrowest first.
_INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def inferred(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with each text column as the first of int, bigint, double, date, timestamp and boolean that holds all its filled cells.

    One aggregation over the cells; a column without a filled cell stays text.
    """
    def named(c: str) -> Column:
        return F.col("`" + c.replace("`", "``") + "`")

    def cell(c: str) -> Column:
        return F.nullif(py_strip(named(c)), F.lit(""))

    fits = [F.min(F.when(cell(c).isNotNull(), cell(c).try_cast(t).isNotNull())).alias(f"{i}_{t}") for i, c in enumerate(columns) for t in _INFERRED]
    found = df.agg(*fits).first() if columns else None
    kinds = {c: next((t for t in _INFERRED if found[f"{i}_{t}"]), None) for i, c in enumerate(columns)}
    return df.select(*[c for c in df.columns if c not in kinds],
                     *[(cell(c).try_cast(kinds[c]) if kinds[c] else F.nullif(named(c), F.lit(""))).alias(c) for c in columns])


def read_sheet(spark: SparkSession, path: str, schema=SHEET_SCHEMA, infer: bool = False,
               with_order: bool = True) -> DataFrame:
    """CSV with a header row, columns found by caption.

    Amounts are read as text and cleaned (``"1,250.50"`` is 1250.5). With
    ``with_order`` the file order columns ``source_file, line_no`` and
    ``bad_cells`` (filled amount cells of the row that hold no amount) are
    added. ``infer=True`` takes the captions and the column types from the
    files instead of ``schema``: each file's columns by its own header.
    """
    if infer:
        raw = captioned_csv(spark, path)
        df = inferred(raw, [c for c in raw.columns if c not in ORDER_COLUMNS])
        return df if with_order else df.drop(*ORDER_COLUMNS)
    raw = captioned_csv(spark, path, {f.name: f.name for f in schema.fields})
    bad = F.lit(0)
    out = []
    for f in schema.fields:
        # an empty cell is a missing one; the reader strips nothing else from text
        cell = F.when(py_strip(F.col(f"`{f.name}`")) != "", F.col(f"`{f.name}`"))
        if f.dataType.typeName() == "double":
            value = clean_amount(cell)
            bad = bad + (cell.isNotNull() & value.isNull()).cast("int")
            out.append(value.alias(f.name))
        else:
            out.append(cell.cast(f.dataType).alias(f.name))
    return raw.select(*ORDER_COLUMNS, *out, bad.alias("bad_cells")) if with_order else raw.select(*out)


# ---------------------------------------------------------------------------
# S2 extracted tables
# ---------------------------------------------------------------------------

def read_raw_tables(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed extracted tables in the ``raw_rows`` contract.

    Any table extractor can land this: one row per table row with positional
    ``headers`` and ``cells`` (all strings). Parquet partitioned by
    ``statement_id`` lets a filter on it prune files.
    """
    return spark.read.schema(RAW_ROWS_SCHEMA).format(fmt).load(path)


# ---------------------------------------------------------------------------
# S5 statement text, S7 statement metadata
# ---------------------------------------------------------------------------

#: Canonical statement columns: output name -> header caption (stripped).
STATEMENT_TEXT_COLUMNS = {
    "txn_date": "Txn Date",
    "value_date": "Value Date",
    "description": "Description",
    "ref_no": "Ref No./Cheque No.",
    "debit": "Debit",
    "credit": "Credit",
    "balance": "Balance",
}
STATEMENT_DATE_FORMAT = "d MMM yyyy"


def statement_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the statement text files: statement_id (file path), line_no, line, is_header, is_blank."""
    return numbered_lines(spark, path, is_header=_is_header(F.col("line")), is_blank=py_strip("line") == "").withColumnRenamed("source_file", "statement_id")


def _header_fields(line: Column) -> Column:
    return F.transform(F.split(line, "\t", -1), lambda f: py_strip(f))


def _is_header(line: Column) -> Column:
    # The substring tests short-circuit, so the per-field strip (a lambda)
    # only runs on the few lines that can be headers.
    fields = _header_fields(line)
    return (line.contains("Balance") & line.contains("Description")
            & F.array_contains(fields, "Balance") & F.array_contains(fields, "Description"))


def _marks(lines: DataFrame) -> DataFrame:
    """Per file: where its header stands (``hk``), the header line, and the first blank line after it (``bk``).

    A file without a header line is listed with NULLs.
    """
    header = F.col("is_header")
    heads = lines.groupBy("statement_id").agg(F.min(F.when(header, F.col("line_no"))).alias("hk"),
                                              F.min_by("line", F.when(header, F.col("line_no"))).alias("header_line"))
    heads = written(heads, "statement-headers")
    blank = _per_file(lines.where("is_blank").select("statement_id", "line_no"), heads.select("statement_id", "hk"), "statement_id")
    ends = blank.where("line_no > hk").groupBy("statement_id").agg(F.min("line_no").alias("bk"))
    return written(heads.join(ends, "statement_id", "left"), "statement-parts")


def read_statement_text(spark: SparkSession, path: str) -> DataFrame:
    """Statement text files (tab separated) -> typed statement rows.

    Skips the ``key : value`` preamble up to the header line, stops at the
    first blank line after it and ignores the trailer. Header captions are
    matched after stripping (padded names, trailing empty field). A file
    without a header line has no rows; ``statement_meta`` reports it. Columns:
    statement_id, line_no, txn_date, value_date (dates),
    description, ref_no (stripped text), debit, credit, balance (doubles).
    """
    lines = statement_lines(spark, path)
    loc = _per_file(lines, _marks(lines).where("hk is not null"), "statement_id")
    rows = loc.where((F.col("line_no") > F.col("hk")) & (F.col("bk").isNull() | (F.col("line_no") < F.col("bk"))))
    hdr = _header_fields(F.col("header_line"))
    fields = F.split(F.col("line"), "\t", -1)

    def field(caption: str) -> Column:
        pos = F.array_position(hdr, caption).cast("int")
        return F.when(pos > 0, py_strip(F.get(fields, pos - 1)))

    out = [F.col("statement_id"), F.col("line_no")]
    for name, caption in STATEMENT_TEXT_COLUMNS.items():
        v = field(caption)
        if name.endswith("_date"):
            v = F.try_to_date(v, STATEMENT_DATE_FORMAT)
        elif name in ("debit", "credit", "balance"):
            v = clean_amount(v)
        out.append(v.alias(name))
    return rows.select(*out)


def statement_meta(spark: SparkSession, path: str) -> DataFrame:
    """Allow-listed preamble facts per statement file.

    Columns: statement_id, period_start, period_end (dates),
    opening_balance (double) and opening_balance_date (date), both from the
    first ``Balance on <date>`` line, and status: ``ok``, or ``no_header``
    for a file without a header line (all its lines are read as preamble).
    Other preamble keys are never read out.
    """
    lines = statement_lines(spark, path)
    marks = _marks(lines)
    pre = _per_file(lines, marks, "statement_id").where(F.col("hk").isNull() | (F.col("line_no") < F.col("hk")))
    parts = F.split(F.col("line"), "\t", 2)
    raw_key = py_strip(F.regexp_replace(F.get(parts, 0), rf":{WS}*$", ""))
    val = py_strip(F.get(parts, 1))
    kv = pre.select("statement_id", "line_no", F.lower(raw_key).alias("key"), raw_key.alias("raw_key"), val.alias("val"))
    aggs = [F.max(F.when(F.col("key") == k, F.try_to_date(F.col("val"), STATEMENT_DATE_FORMAT)))
            .alias(name) for k, name in STATEMENT_META_KEYS.items()]
    is_open = F.col("key").startswith(OPENING_BALANCE_PREFIX)
    open_date = py_strip(F.substr(F.col("raw_key"), F.lit(len(OPENING_BALANCE_PREFIX) + 1)))
    opening = F.struct(clean_amount(F.col("val")).alias("amount"), F.try_to_date(open_date, STATEMENT_DATE_FORMAT).alias("day"))
    facts = kv.groupBy("statement_id").agg(*aggs, F.min_by(opening, F.when(is_open, F.col("line_no"))).alias("opening"))
    status = F.when(F.col("hk").isNull(), "no_header").otherwise("ok")
    return marks.join(facts, "statement_id", "left").select(
        "statement_id", *STATEMENT_META_KEYS.values(), F.col("opening.amount").alias("opening_balance"),
        F.col("opening.day").alias("opening_balance_date"), status.alias("status"))


# ---------------------------------------------------------------------------
# S6 consolidated statement CSV
# ---------------------------------------------------------------------------

def read_statement_csv(spark: SparkSession, path: str) -> DataFrame:
    """Consolidated statement CSV (BOM, padded captions, ``' '`` blanks,
    quoted grouped amounts, ``dd-MMM-yy`` dates) -> typed statement rows.
    Two-digit years pivot at 69 as in Python (Spark's ``yy`` always means 20yy).
    Every file's columns are found by its own header.

    Columns: statement_id, line_no, value_date, description, ref_no, debit, credit, balance.
    """
    captions = {name: caption for name, caption in STATEMENT_TEXT_COLUMNS.items() if name != "txn_date"}
    raw = captioned_csv(spark, path, captions)
    return raw.select(
        F.col("source_file").alias("statement_id"), "line_no",
        parse_day_month_yy(py_strip("value_date")).alias("value_date"),
        py_strip("description").alias("description"),
        py_strip("ref_no").alias("ref_no"),
        *[clean_amount(py_strip(c)).alias(c) for c in ("debit", "credit", "balance")])


# ---------------------------------------------------------------------------
# U2 consolidation
# ---------------------------------------------------------------------------

def read_statement_periods(spark: SparkSession, path: str, period: str = r"/period=([0-9]+)/") -> DataFrame:
    """U2 for periods whose text statements lie under one folder: read once, ``period_idx`` told from the file's path.

    ``period`` is a pattern with the number as its group; a file whose path
    does not match has no period (NULL). The rows equal those of
    ``consolidate`` over the periods read one by one.
    """
    rows = read_statement_text(spark, path)
    return rows.withColumn("period_idx", F.nullif(F.regexp_extract("statement_id", period, 1), F.lit("")).cast("int"))


def consolidate(*periods: DataFrame) -> DataFrame:
    """Union statement periods into one table, ``period_idx`` first in order.

    Inputs are matched by column name; columns missing from a period are NULL.
    """
    if not periods:
        raise ValueError("consolidate needs at least one DataFrame")
    tagged = [p.withColumn("period_idx", F.lit(i)) for i, p in enumerate(periods)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
