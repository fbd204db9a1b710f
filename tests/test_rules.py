"""Edge cases of the cleaning rules, on small hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from salesmart.functions.dates import parse_sales_date
from salesmart.functions.numeric import coerce_number
from salesmart.functions.text import strip
from salesmart.operators import customers as CU


def _one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_strip_removes_all_ascii_whitespace(spark):
    assert _one(spark, strip, ["\t a b \n", "  ", None]) == ["a b", "", None]


def test_strip_removes_what_python_strips(spark):
    import sys

    spaces = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
    assert _one(spark, strip, [f"{s}T{s}1{s}" for s in spaces]) == [f"T{s}1" for s in spaces]
    assert _one(spark, strip, ["\u200bT1"]) == ["\u200bT1"]


def test_number_coercion(spark):
    got = _one(spark, coerce_number, ["12", " -1.5 ", "12d", "inf", "n/a", "", None, "1e3", ".5"])
    assert got == [12.0, -1.5, None, None, None, None, None, 1000.0, 0.5]


def test_date_formats_in_order(spark):
    got = _one(spark, parse_sales_date, [
        "03-05-2012", "2012/05/03", "03 May 2012", "2012-05-03", "2012-05-03T23:30:00-05:00",
        "2012/05/03 10:11:12", "5/3/2012", "13/4/2023", "31-02-2024", "invalid_date", "", None, "2024"])
    d = dt.date
    assert got == [d(2012, 5, 3), d(2012, 5, 3), d(2012, 5, 3), d(2012, 5, 3), d(2012, 5, 3),
                   d(2012, 5, 3), d(2012, 5, 3), d(2023, 4, 13), None, None, None, None, None]


def test_dates_of_the_general_parser(spark):
    forms = {
        "May 3, 2012": (2012, 5, 3), "03-May-2012": (2012, 5, 3), "3/5/12": (2012, 3, 5), "2012.05.03": (2012, 5, 3), "3 May 2012 10:11": (2012, 5, 3), "05/03/2012 10:11": (2012, 5, 3),
        "13/5/12": (2012, 5, 13), "03.05.2012": (2012, 3, 5), "13.05.2012": (2012, 5, 13), "05-03-2012 10:11": (2012, 5, 3), "05-03-2012": (2012, 3, 5), "MAY 3 2012": (2012, 5, 3),
        "3 Sept 2012": (2012, 9, 3), "3-5-12": (2012, 3, 5), "May-03-2012": (2012, 5, 3), "20120503": (2012, 5, 3), "20120503 10:11": (2012, 5, 3), "2012 May 3": (2012, 5, 3), "3/5/68": (2068, 3, 5), "3/5/75": (1975, 3, 5),
        "September 30, 2012 11:59:59 PM": (2012, 9, 30), "12/31/2012 23:59:59.999": (2012, 12, 31), "2012-5-3T10:00": (2012, 5, 3), "29 Feb 2012": (2012, 2, 29),
        "29 Feb 2013": None, "3 Mai 2012": None, "14/14/2012": None, "2012-13-01": None, "99999999": None, "May": None, "5 2012": None, "1.5": None, "12:30": None, "3/5/12345": None, "-": None,
    }
    got = dict(zip(forms, _one(spark, parse_sales_date, list(forms)), strict=True))
    assert got == {k: v and dt.date(*v) for k, v in forms.items()}


def test_customer_rules(spark):
    assert _one(spark, CU.clean_name, ["", None, "x" * 300, "Ann"]) == ["Unknown", "Unknown", "x" * 255, "Ann"]
    assert _one(spark, CU.clean_email, ["", "bad", "a@b"]) == ["Unknown", "invalid", "a@b"]
    assert _one(spark, CU.clean_join_date, ["2024-04-31", "2023/04/05", "2022-09-15T00:00:00Z", "invalid_date",
                                            "", "2024-4-1"]) == \
        ["20240431", "20230405", "20220915", "19900101", "19900101", "19900101"]
    assert _one(spark, lambda c: CU.clean_loyalty(c), ["", "-840", "12"]) == ["0", "0", "12"]
