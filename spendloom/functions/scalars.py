"""Scalar cleaners: Column -> Column, built only from Spark expressions.

Each function returns an expression that runs inside whole-stage codegen (the
few that walk arrays use Spark's higher-order functions). None of them calls
Python per row. Tags: W = on the wired statement path, H = helper that the
original tool defines but never calls, D = implied by the shipped data only.

Regex dialect notes
-------------------
* Whitespace follows Python's ``str.strip``/``\\s``: Unicode White_Space plus
  the four ASCII information separators (U+001C..U+001F), spelled out as a
  character class (``WS``); Spark's ``trim`` only strips spaces.
* Digits are ASCII ``[0-9]``. Python would also accept other Unicode decimal
  digits; that is a documented divergence.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendloom.schema import (AMOUNT_TOKEN_PATTERNS, BANK_TRANSFER_PATTERN, DATE_PATTERNS,
                              DEPOSIT_KEYWORDS, DESCRIPTION_LABELS, DESCRIPTION_TERMS_AFTER,
                              DESCRIPTION_TRAILING_PATTERNS, MONTH_ABBREVIATIONS,
                              MONTH_DAY_PATTERN, PHONE_MARKER, WITHDRAWAL_KEYWORDS)

ColumnOrName = "Column | str"

#: One whitespace character as Python counts it (``str.isspace``), spelled
#: out so Java needs no Unicode-property lookups ((?U) is much slower).
WS = (r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def _java(pattern: str) -> str:
    """A fixed pattern with Python's white space."""
    return pattern.replace(r"\s", WS)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def regex_escape(term: str) -> str:
    """Escape a literal so Java and RE2 both read it as plain text."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", term)


#: The characters Python's ``str.strip()`` removes (``str.isspace()``).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 + "".join(chr(c) for c in range(0x2000, 0x200B))
                 + "\u2028\u2029\u202f\u205f\u3000")


def py_strip(c) -> Column:
    """Python ``str.strip()``: drop leading and trailing whitespace.

    A character-set trim, not a regex: cheap and small in generated code.
    """
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def _months_lower() -> Column:
    return F.array(*[F.lit(m.lower()) for m in MONTH_ABBREVIATIONS])


def month_number(token) -> Column:
    """1-12 for an English month abbreviation (any case), NULL otherwise."""
    return F.nullif(F.array_position(_months_lower(), F.lower(_c(token))), F.lit(0)).cast("int")


# ---------------------------------------------------------------------------
# A1 clean_amount (W)
# ---------------------------------------------------------------------------

#: What a cleaned amount must look like to parse: an optional sign (a second
#: leading '-' is the rest's own sign), digits with at most one dot.
AMOUNT_SHAPE = r"^-{0,2}([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def clean_amount(c) -> Column:
    """Text -> double. Keep digits, '.', '-'; a leading '-' negates the rest.

    ``1,234.50`` -> 1234.5, ``(500)`` -> 500.0, ``Rs. 500`` -> 0.5,
    ``--5`` -> 5.0, ``-``/empty/``1.2.3``/``500-`` -> NULL. NULL -> NULL.
    """
    z = F.regexp_replace(_c(c).cast("string"), r"[^0-9.\-]", "")
    rest = F.substr(z, F.lit(2))
    # Only text that is a number gets cast: Spark's try_cast catches a parse
    # exception per bad value, which is slow on dirty columns.
    parsed = (F.when(z.startswith("-"), -rest.try_cast("double"))
              .otherwise(z.try_cast("double")))
    return F.when(z.rlike(AMOUNT_SHAPE), parsed)


# ---------------------------------------------------------------------------
# A3 clean_description (W)
# ---------------------------------------------------------------------------

def description_labels(extra_noise_terms: Iterable[str] = ()) -> list[str]:
    """The patterns that begin a span, in order (flags not included)."""
    at = DESCRIPTION_LABELS.index(DESCRIPTION_TERMS_AFTER) + 1
    return DESCRIPTION_LABELS[:at] + [regex_escape(t) for t in extra_noise_terms] + DESCRIPTION_LABELS[at:]


def _without_spans(text: Column, label: str) -> Column:
    """Drop every span from a label to the next phone marker; a label with no marker after it stays.

    Only the text up to the last marker is searched for labels: each label
    there has a marker after it, so each search ends where the next one
    begins, and the time is linear in the text however many labels it holds
    and wherever the markers stand. (Searched in the whole text, every label
    behind the last marker would run to the end of the text and fail.)
    """
    def cut(t: Column) -> Column:
        head = F.regexp_extract(t, _java_description(f"^.*{PHONE_MARKER}"), 0)
        return F.transform(F.array(head), lambda h: F.concat(F.regexp_replace(h, _java_description(f"{label}.*?{PHONE_MARKER}"), ""), F.substr(t, F.length(h) + 1)))[0]

    return F.transform(F.array(text), cut)[0]


def _java_description(pattern: str) -> str:
    # Python's \d is any Unicode decimal digit (\p{Nd}); (?u) gives
    # Unicode case folding like Python's IGNORECASE on text.
    return "(?isu)" + pattern.replace(r"\d", r"\p{Nd}")


def clean_description(c, extra_noise_terms: Iterable[str] = ()) -> Column:
    """Remove boilerplate spans in order, collapse whitespace, '' -> NULL.

    Patterns are applied one after the other, case-insensitive with '.'
    matching newlines; the header caption's three spaces are matched before
    whitespace is collapsed. Linear in the length of the text.
    """
    s = py_strip(c)
    # Every span ends at the phone marker: without a marker in the
    # text there is none, so one scan decides whether to look for them.
    spans = s
    for label in description_labels(extra_noise_terms):
        spans = _without_spans(spans, label)
    s = F.when(s.rlike(_java_description(PHONE_MARKER)), spans).otherwise(s)
    for p in DESCRIPTION_TRAILING_PATTERNS:
        s = F.regexp_replace(s, _java_description(p), "")
    s = py_strip(F.regexp_replace(s, rf"{WS}+", " "))
    return F.nullif(s, F.lit(""))


# ---------------------------------------------------------------------------
# A4 format_description, A5 is_bank_transfer (W)
# ---------------------------------------------------------------------------

def format_description(c) -> Column:
    """``first/second/.../last`` -> ``first (second) - last``.

    Blank second or last parts are left out; middle parts are dropped; text
    without '/' is returned stripped. ``/`` gives the empty string.
    """
    # Everything is read from the split array, so the input expression is
    # referenced once (no copies of an upstream cleaner in generated code).
    parts = F.split(py_strip(c), "/", -1)
    first = py_strip(F.get(parts, 0))
    second = py_strip(F.get(parts, 1))
    last = py_strip(F.element_at(parts, -1))
    formatted = F.concat(
        first,
        F.when(second != "", F.concat(F.lit(" ("), second, F.lit(")"))).otherwise(F.lit("")),
        F.when((F.size(parts) > 2) & (last != ""), F.concat(F.lit(" - "), last)).otherwise(F.lit("")),
    )
    return F.when(F.size(parts) > 1, formatted).otherwise(F.get(parts, 0))


def is_bank_transfer(c) -> Column:
    """RTGS/NEFT credit or debit wording (detected only; text is unchanged)."""
    return _c(c).rlike("(?i)" + _java(BANK_TRANSFER_PATTERN))


# ---------------------------------------------------------------------------
# A6 month_day (W)
# ---------------------------------------------------------------------------

def month_day(c) -> Column:
    """struct<month int, day int> from the first month-day token, else NULLs.

    Only the first hit counts: if its letters are not a month the row has no
    date, even when a real one follows. Days are not validated.
    """
    c = _c(c)
    tok = F.regexp_extract(c, _java(MONTH_DAY_PATTERN), 1)
    day = F.regexp_extract(c, _java(MONTH_DAY_PATTERN), 2)
    month = month_number(tok)
    return F.struct(month.alias("month"),
                    F.when(month.isNotNull(), day.cast("int")).alias("day"))


def iso_date_text(year, month, day) -> Column:
    """``yyyy-MM-dd`` text without validating the day (``2024-02-99`` stays).

    Years beyond 9999 are printed whole. Built with ``lpad``/``concat`` (no
    ``java.util.Formatter`` per row).
    """
    def pad(c, n):
        # lpad also cuts what is longer
        text = _c(c).cast("string")
        return F.when(F.length(text) < n, F.lpad(text, n, "0")).otherwise(text)
    return F.concat(pad(year, 4), F.lit("-"), pad(month, 2), F.lit("-"), pad(day, 2))


def valid_date(year, month, day) -> Column:
    """The date, or NULL when (year, month, day) is not a real date in 1..9999.

    Range guards keep almost every bad value away from the constructor (a
    ``try_*`` function pays for a caught exception on each bad value), and
    each component appears only twice in the expression, which keeps the
    generated code small when the components are themselves expressions.
    """
    y, m, d = _c(year), _c(month), _c(day)
    ok = y.between(1, 9999) & m.between(1, 12) & d.between(1, 31)
    return F.when(ok, F.to_date(F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0))))


# ---------------------------------------------------------------------------
# A9, A10, A7, A8 amount extraction (H)
# ---------------------------------------------------------------------------

def has_keyword(c, words: Iterable[str]) -> Column:
    """Any word is a substring of the upper-cased text."""
    u = F.upper(_c(c))
    return _any(u.contains(w) for w in words)


def amount_tokens(c) -> Column:
    """array<string>: tokens of the three amount patterns, pattern by pattern."""
    c = _c(c)
    return F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in AMOUNT_TOKEN_PATTERNS])


def _extract_amount(row_text, cell, balance, keywords) -> Column:
    row_text, cell = _c(row_text), _c(cell)
    bal = clean_amount(balance)
    val = clean_amount(cell)
    from_cell = F.when(cell.isNotNull() & (val > 0) & (bal.isNull() | (val != bal)), val)
    # Tokens hold only digits, commas and dots, so cleaning one is dropping
    # its commas: done on the joined list and cast as an array (no per-token
    # lambda). Amounts are never negative, so removing the balance and the
    # zeros leaves the candidates in order; the first one wins.
    joined = F.array_join(amount_tokens(row_text), "|")
    amounts = F.split(F.replace(joined, F.lit(","), F.lit("")), r"\|", -1).try_cast("array<double>")
    cands = F.array_remove(F.array_remove(amounts, F.coalesce(bal, F.lit(-1.0))), F.lit(0.0))
    from_text = F.when(has_keyword(row_text, keywords), F.get(cands, 0))
    return F.coalesce(from_cell, from_text)


def extract_withdrawal_amount(row_text, cell, balance) -> Column:
    """Cell amount if positive and not the balance; else, when the text has a
    withdrawal keyword, the first such token of the text; else NULL."""
    return _extract_amount(row_text, cell, balance, WITHDRAWAL_KEYWORDS)


def extract_deposit_amount(row_text, cell, balance) -> Column:
    """As ``extract_withdrawal_amount`` with the deposit keywords."""
    return _extract_amount(row_text, cell, balance, DEPOSIT_KEYWORDS)


# ---------------------------------------------------------------------------
# A2 clean_date (H)
# ---------------------------------------------------------------------------

_DMY4, _DMY2, _MDY, _DMY_TEXT = map(_java, DATE_PATTERNS)
_YMD = r"\d{4}-\d{2}-\d{2}"


def _whole(pattern: str) -> str:
    """Not inside a longer run of digits."""
    return rf"(?<!\d)(?:{pattern})(?!\d)"


def valid_iso_date(year, month, day) -> Column:
    """``yyyy-MM-dd`` when (year, month, day) is a real date in 1..9999."""
    return valid_date(year, month, day).cast("string")


def _pivot_two_digit_year(yy: Column) -> Column:
    # Python's %y: 69-99 -> 1969-1999, 00-68 -> 2000-2068.
    return F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)


def _to_int(s: Column) -> Column:
    return F.nullif(s, F.lit("")).try_cast("int")


def _parse_numeric(frag: Column, two_digit: bool, slash_only: bool) -> Column:
    # ``frag`` is a whole ``dd?mm?yy[yy]`` match (or empty): fixed positions.
    d = F.substring(frag, 1, 2).try_cast("int")
    m = F.substring(frag, 4, 2).try_cast("int")
    y = F.substring(frag, 7, 2 if two_digit else 4).try_cast("int")
    if two_digit:
        y = _pivot_two_digit_year(y)
    ok = frag != ""
    if slash_only:
        ok = ok & ~frag.contains("-")
    return F.when(ok, valid_iso_date(y, m, d))


def _parse_text(frag: Column, month_first: bool, default_year: Column | None,
                year_group: bool = True) -> Column:
    # ``frag`` is a whole "Mon d[ yyyy]" / "d Mon[ yyyy]" match (or empty).
    # One cached regex folds its whitespace to single spaces, so the split is
    # on a plain character (no pattern compiled per row); the parts are bound
    # once and read by position.
    def read(parts):
        g1, g2 = F.get(parts, 0), F.get(parts, 1)
        g3 = _to_int(F.get(parts, 2)) if year_group else F.lit(None).cast("int")
        mon, day = (g1, g2) if month_first else (g2, g1)
        year = g3 if default_year is None else F.coalesce(g3, default_year)
        return valid_iso_date(year, month_number(mon), _to_int(day))
    parts = F.split(F.regexp_replace(frag, rf"{WS}+", " "), " ", -1)
    return F.when(frag != "", bind(parts, read))


def bind(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once.

    Column expressions are trees: a value used in several places is copied
    into each, and nested cleaners multiply the copies in generated code. A
    one-element ``transform`` binds the value to a lambda variable instead.
    """
    return F.get(F.transform(F.array(value), fn), 0)


def clean_date(c, today: _dt.date | None = None, mode: str = "compat") -> Column:
    """Date text -> ``yyyy-MM-dd`` text or NULL.

    ``compat`` reproduces the original cascade exactly: four patterns in order
    (``dd/mm/yyyy``, ``dd/mm/yy``, ``Mon d yyyy``, ``d Mon yyyy``) and a final
    ``d Mon`` + current year fallback, where a pattern's matched text replaces
    the working text even if it then fails to parse. ``strict`` is the evident
    intent: each pattern sees the whole text but never part of a longer run of
    digits, ``-`` separators and ``yyyy-mm-dd`` are accepted, a missing year
    is the current one, and a full date that does not exist is NULL, not read
    again as something shorter. ``today`` fixes "current" so runs are
    repeatable.
    """
    if mode not in ("compat", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    today = today or _dt.date.today()
    cur_year = F.lit(today.year)
    c = _c(c)
    s0 = py_strip(c)
    own = _whole if mode == "strict" else str
    frags = F.struct(F.regexp_extract(s0, own(_DMY4), 0).alias("f1"),
                     F.regexp_extract(s0, own(_DMY2), 0).alias("f2"),
                     F.regexp_extract(s0, own(_MDY), 0).alias("f3"),
                     F.regexp_extract(s0, own(_DMY_TEXT), 0).alias("f4"),
                     F.regexp_extract(s0, own(_YMD), 0).alias("iso"))

    if mode == "strict":
        def pick(t):
            f1, f2, f3, f4, iso = t["f1"], t["f2"], t["f3"], t["f4"], t["iso"]
            year, month, day = (F.substring(iso, at, n).try_cast("int") for at, n in ((1, 4), (6, 2), (9, 2)))
            return F.coalesce(
                _parse_numeric(f1, False, False),
                F.when(iso != "", valid_iso_date(year, month, day)),
                _parse_numeric(f2, True, False),
                # Patterns with an explicit year win over the year-less readings.
                _parse_text(f3, True, None),
                _parse_text(f4, False, None),
                _parse_text(f3, True, cur_year),
                _parse_text(f4, False, cur_year),
            )
        return F.when(c.isNotNull(), bind(frags, pick))

    # Closed form of the cascade. Once a pattern matches, the working text is
    # that fragment, and a failed fragment can only feed one later pattern:
    #   dd?dd?dddd   -> its first 8 characters as dd/mm/yy
    #   d Mon[ yyyy] -> its leading "d Mon" with the current year
    # The other fragments (dd?dd?yy, "Mon d[ yyyy]") match nothing later.
    def cascade(t):
        f1, f2, f3, f4 = t["f1"], t["f2"], t["f3"], t["f4"]
        return (F.when(f1 != "", F.coalesce(_parse_numeric(f1, False, True),
                                            _parse_numeric(F.substring(f1, 1, 8), True, True)))
                .when(f2 != "", _parse_numeric(f2, True, True))
                .when(f3 != "", _parse_text(f3, True, None))
                .when(f4 != "", F.coalesce(_parse_text(f4, False, None),
                                           _parse_text(f4, False, cur_year, year_group=False))))
    return F.when(c.isNotNull(), bind(frags, cascade))


# ---------------------------------------------------------------------------
# A11 parse_sheet_date (D)
# ---------------------------------------------------------------------------

def parse_sheet_date(c) -> Column:
    """``d-M-yyyy`` or ``d-M-yy`` (two-digit years are 20yy) -> date."""
    c = _c(c)
    long_year = r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})$"
    short_year = r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{2})$"

    def parts(p, century):
        d = F.regexp_extract(c, p, 1).try_cast("int")
        m = F.regexp_extract(c, p, 2).try_cast("int")
        y = F.regexp_extract(c, p, 3).try_cast("int") + F.lit(century)
        return valid_date(y, m, d)
    # Shape first, then arithmetic validation: no parser exception per row.
    return F.when(c.rlike(long_year), parts(long_year, 0)).when(c.rlike(short_year), parts(short_year, 2000))


def parse_day_month_yy(c) -> Column:
    """``dd-MMM-yy`` (statement CSV dates) -> date, two-digit years pivoted at
    69 like Python's ``%y`` (69-99 -> 19xx, 00-68 -> 20xx)."""
    c = _c(c)
    pattern = r"^([0-9]{1,2})-([A-Za-z]{3})-([0-9]{2})$"
    d = F.regexp_extract(c, pattern, 1).try_cast("int")
    m = month_number(F.regexp_extract(c, pattern, 2))
    y = _pivot_two_digit_year(F.regexp_extract(c, pattern, 3).try_cast("int"))
    return F.when(c.rlike(pattern), valid_date(y, m, d))
