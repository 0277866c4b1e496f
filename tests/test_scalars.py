"""Vector tests for the scalar cleaners."""

import datetime as dt
import random
import re
import time

from helpers import one_col
from pyspark.sql import functions as F

from spendloom.functions import scalars as S


def test_clean_amount_vectors(spark):
    cases = {
        "1,234.50": 1234.5, "₹1,234.50": 1234.5, "1,00,000.00": 100000.0,
        "Rs. 500": 0.5, "1e5": 15.0, "(500)": 500.0, "--5": 5.0, "-": None,
        "": None, "abc": None, "1.2.3": None, "500-": None, "5.": 5.0,
        None: None, "-12.5": -12.5, " 7 ": 7.0,
    }
    got = one_col(spark, list(cases), S.clean_amount)
    assert got == list(cases.values())


def test_format_description_vectors(spark):
    cases = {
        "a/b": "a (b)", "/b": " (b)", "a//c": "a - c", "a/": "a", "a//": "a",
        "/": "", "x / y / z / w ": "x (y) - w", "plain text ": "plain text",
        None: None, "SHOP/ab12/ref": "SHOP (ab12) - ref",
    }
    assert one_col(spark, list(cases), S.format_description) == list(cases.values())


def test_clean_description(spark):
    cases = {
        "  Dec 30   SHOP  ": "Dec 30 SHOP",
        "Balance Brought Forward": None,
        "Pay STATEMENT DATE 1 x\nPhone No.: 12345 rest": "Pay rest",
        "account no 99 and nothing else": "account no 99 and nothing else",
        "Date   Value Description Date Jan 02 X": "Jan 02 X",
        "Date Value Description Date": "Date Value Description Date",
        "call Phone No.: 777 now": "call now",
        None: None,
    }
    assert one_col(spark, list(cases), S.clean_description) == list(cases.values())


def test_clean_description_locality_terms(spark):
    f = lambda c: S.clean_description(c, extra_noise_terms=["Hill Road"])
    assert one_col(spark, ["x Hill Road 5 Phone No.: 1 y"], f) == ["x y"]


def test_month_day(spark):
    cases = {
        "Dec 30 SHOP": (12, 30), "NEFT 12 Mar 05": (None, None), "Omar 12": (3, 12),
        "Mar 2024 x": (3, 20), "Feb 99 ODD": (2, 99), "nan": (None, None),
        "jan 2": (1, 2), "no date": (None, None),
    }
    got = one_col(spark, list(cases), S.month_day)
    assert [(r["month"], r["day"]) for r in got] == list(cases.values())


def test_clean_date_compat(spark):
    today = dt.date(2026, 6, 1)
    cases = {
        "12/03/2024": "2024-03-12", "12-03-2024": None, "12-03-24": None,
        "12/03/68": "2068-03-12", "12/03/69": "1969-03-12", "1/2/2024": None,
        "Mar 15 2024": "2024-03-15", "MAR 15 2024": "2024-03-15", "March 15 2024": None,
        "15 Mar 2024": None, "Mar 15": None, "15 Mar": "2026-03-15", "31/02/2024": None,
        "29/02/2023": "2020-02-29", "01/01/0000": "2000-01-01", None: None,
    }
    got = one_col(spark, list(cases), lambda c: S.clean_date(c, today=today))
    assert got == list(cases.values())


def test_clean_date_strict(spark):
    today = dt.date(2026, 6, 1)
    cases = {
        "12-03-2024": "2024-03-12", "15 Mar 2024": "2024-03-15", "Mar 15": "2026-03-15",
        "12/03/2024": "2024-03-12", "12-03-24": "2024-03-12",
    }
    got = one_col(spark, list(cases), lambda c: S.clean_date(c, today=today, mode="strict"))
    assert got == list(cases.values())


def test_extract_amounts(spark):
    df = spark.createDataFrame([
        (0, "pay 1234.50 and 1,00,000.00 and 12,345.60 UPI", None, None),
        (1, "UPI 500 x", "200.00", "1,000.00"),
        (2, "UPI 1,000.00 then 25", None, "1,000.00"),
        (3, "nothing here 55", None, None),
        (4, "SALARY 77 NEFT", None, None),
        (5, "UPI", "0.00", None),
    ], "i int, t string, cell string, bal string")
    out = df.select("i", S.extract_withdrawal_amount("t", "cell", "bal").alias("w"),
                    S.extract_deposit_amount("t", "cell", "bal").alias("d")).orderBy("i").collect()
    assert [r.w for r in out] == [123.0, 200.0, 25.0, None, 77.0, None]
    assert [r.d for r in out] == [None, 200.0, None, None, 77.0, None]


def test_amount_tokens_and_keywords(spark):
    got = one_col(spark, ["pay 1234.50 x"], S.amount_tokens)
    assert got[0] == ["123", "4.50", "1234.50", "1234", "50"]
    assert one_col(spark, ["neft credit", "x"], lambda c: S.has_keyword(c, ["NEFT CREDIT"])) == [True, False]
    assert one_col(spark, ["RTGS  CRED x", "neft deb", "upi"], S.is_bank_transfer) == [True, True, False]


def test_parse_sheet_date(spark):
    got = one_col(spark, ["1-6-2025", "2-6-25", "16-6-25", "bad", None], S.parse_sheet_date)
    assert got == [dt.date(2025, 6, 1), dt.date(2025, 6, 2), dt.date(2025, 6, 16), None, None]


def test_strict_dates_read_no_part_of_a_longer_number(spark):
    cases = {"2001-05-03": "2001-05-03", "29/02/2023": None, "29/02/2024": "2024-02-29", "2023-02-29": None, "29-02-24": "2024-02-29",
             "129/02/2024": None, "29/02/20245": None, "May 12 20015": "2026-05-12", "3 May 1999": "1999-05-03", "": None, None: None}
    got = one_col(spark, list(cases), lambda c: S.clean_date(c, today=dt.date(2026, 6, 1), mode="strict"))
    assert got == list(cases.values())


def test_years_beyond_9999_stay_whole(spark):
    got = one_col(spark, [12, 2024, 9999, 10000, 12345], lambda c: S.iso_date_text(c, F.lit(1), F.lit(2)), "int")
    assert got == ["0012-01-02", "2024-01-02", "9999-01-02", "10000-01-02", "12345-01-02"]


def test_headers_are_read_stripped_and_in_any_case(spark):
    from spendloom.operators.normalise import map_roles
    df = spark.createDataFrame([([" Value Date ", "\tDEBIT\n", None, "Balance"], ["a", "b", "c", "d"])], "headers array<string>, cells array<string>")
    row = map_roles(df).first()
    assert (row.pos_date_desc, row.pos_withdrawal, row.pos_deposit, row.pos_balance, row.usable) == (1, 2, 0, 4, True)
    # a role without aliases is absent, and a table without it is unusable
    assert map_roles(df, {"date_desc": ["date"]}).first().usable is False


def _described(text, extra=()):
    """The spans removed one pattern after the other from the whole text."""
    if text is None:
        return None
    text = text.strip()
    for label in S.description_labels(extra):
        text = re.sub(rf"{label}.*?{S.PHONE_MARKER}", "", text, flags=re.I | re.S)
    for pattern in S.DESCRIPTION_TRAILING_PATTERNS:
        text = re.sub(pattern, "", text, flags=re.I)
    return re.sub(r"\s+", " ", text).strip() or None


def test_spans_as_by_whole_text_patterns(spark):
    rnd = random.Random(6)
    bits = [*S.DESCRIPTION_LABELS, "Hill Road", "Phone", "Phone No.: 12", "phone no.: 9", "Phone No.: x", "STATE", "MENT DATE", "IF", "SC", "word", "\n", "5", "Balance Brought Forward"]
    texts = ["".join(rnd.choice(bits) + rnd.choice(["", " "]) for _ in range(rnd.randint(1, 25))) for _ in range(400)]
    texts += ["CURRENCY Phone No.: 1" * 3 + "tail CURRENCY", "Phone No.: 1 IFSC", "ACCOUNT NO a CURRENCY b Phone No.: 1 ACCOUNT NO c CURRENCY", None, ""]
    for extra in ((), ("Hill Road", "Phone")):
        got = one_col(spark, texts, lambda c: S.clean_description(c, extra))
        assert got == [_described(t, extra) for t in texts]


def test_spans_take_linear_time(spark):
    """Many labels behind one early marker: four times the text is not sixteen times the work."""
    def seconds(n):
        df = spark.createDataFrame([("x Phone No.: 1 " + "CURRENCY and account no " * n,)] * 3, "v string").coalesce(1)
        best = []
        for _ in range(3):
            t0 = time.perf_counter()
            df.select(F.length(S.clean_description("v")).alias("n")).agg(F.sum("n")).collect()
            best.append(time.perf_counter() - t0)
        return min(best)

    small = seconds(5_000)
    assert seconds(40_000) < 20 * small + 2  # 8 times the text; by the square it would be 64 times
