"""Date parsing: the fixed formats, then a general parser, both by the value's layout.

A value's layout is its signature: month names and digit runs replaced by a letter for their class,
separators kept.  One lookup in a table says how to turn its parts into year-month-day, so no format is
tried on values of another layout.  ``try_cast`` validates the calendar day without raising.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import chain

from pyspark.sql import Column, functions as F

from .text import strip

# English month names; the part in brackets may be missing.
MONTHS = ("jan(uary)?", "feb(ruary)?", "mar(ch)?", "apr(il)?", "may", "june?", "july?", "aug(ust)?", "sep(t|tember)?", "oct(ober)?", "nov(ember)?", "dec(ember)?")
# Fixed value: years of two digits below this belong to the 2000s (its tens and units as a pattern), the others to the 1900s.
TWO_DIGITS_2000 = r"[0-6]\d|7[0-4]"

# Signature -> order of its three parts, an alternative for days that the first order does not have.
# Y is a number of four digits, N one of one or two, E one of eight, m a word.
LAYOUTS = {
    "N-N-Y": ("dmy", "mdy"),  # the first fixed format reads the day first
    "Y/N/N": ("ymd", None), "Y-N-N": ("ymd", None), "Y.N.N": ("ymd", None), "Y N N": ("ymd", None),
    "N m Y": ("dmy", None), "N-m-Y": ("dmy", None), "N/m/Y": ("dmy", None), "N.m.Y": ("dmy", None), "N m, Y": ("dmy", None),
    "m N Y": ("mdy", None), "m N, Y": ("mdy", None), "m-N-Y": ("mdy", None), "m/N/Y": ("mdy", None), "m. N, Y": ("mdy", None),
    "Y m N": ("ymd", None), "Y-m-N": ("ymd", None), "Y/m/N": ("ymd", None),
    "N/N/Y": ("mdy", "dmy"), "N.N.Y": ("mdy", "dmy"),  # the general parser reads the month first
    "N/N/N": ("mdy", "dmy"), "N-N-N": ("mdy", "dmy"), "N.N.N": ("mdy", "dmy"),
    "N m N": ("dmy", None), "N-m-N": ("dmy", None), "m N, N": ("mdy", None),
}
# Fixed value: a time of day behind a date, which is not converted.
TIME = r"[T ]+\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?( ?[AaPp]\.?[Mm]\.?)?( ?(Z|UTC|GMT|[+-]\d{2}:?\d{2}))?$"
# Fixed value: behind a year-first date anything after T or a space is left out.
YEAR_FIRST = r"^\d{4}([-/])\d{1,2}\1\d{1,2}([T ].*)?$"
YEAR_LAST = r"^\d{1,2}([-/.])\d{1,2}\1\d{4}$"
YEAR_LAST_PARTS = r"^(\d+)[-/.](\d+)[-/.](\d+)$"


#: How three parts are put into year-month-day.
ORDERS = {"dmy": "$3-$2-$1", "mdy": "$3-$1-$2", "ymd": "$1-$2-$3"}
PARTS = r"^#?(\d+)[-/., ]+#?(\d+)[-/., ]+#?(\d+)$"


#: Any month name; its number is the place of its first three letters among ``STEMS``.
MONTH_WORD = rf"(?i)\b({'|'.join(MONTHS)})\b"
STEMS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _named(s: Column) -> Column:
    """The month name as # and its number (a value with two names is no date)."""
    stem = F.left(F.lower(F.regexp_extract(s, MONTH_WORD, 1)), F.lit(3))
    number = F.floor((F.instr(F.lit(STEMS), stem) + 2) / 3)
    return F.when(s.rlike("[A-Za-z]{3}"), F.regexp_replace(s, F.lit(MONTH_WORD), F.concat(F.lit("#"), number))).otherwise(s)


def _signature(dated: Column) -> Column:
    """Month names -> m, numbers of four, one or two digits -> Y, N.  Longer runs become two letters side by side, which no layout has."""
    zeros = F.translate(dated, "123456789", "000000000")
    return reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), (("#00", "m"), ("#0", "m"), ("0000", "Y"), ("00", "N"), ("0", "N")), zeros)


def _table(which: int) -> Column:
    """Signature -> replacement of the parts; of a value with a time of day the signature ends with t."""
    rows = {}
    for signature, orders in LAYOUTS.items():
        timed = orders[::-1] if signature == "N-N-Y" else orders  # the fixed format takes no time of day
        for key, order in ((signature, orders[which]), (f"{signature}t", timed[which])):
            if order:
                rows[key] = ORDERS[order]
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in rows.items()))


def parse_sales_date(c: Column) -> Column:
    """Parse a raw date string to a ``date``; null when nothing matches.

    Day-first ``dd-mm-yyyy`` is one of the fixed formats, which take no time of day; with one, and in
    all other layouts of three numbers without a leading year, the month comes first unless there is no such month.
    The usual layouts, year first or three numbers with the year last, take a pattern each; only the others take several.
    """
    s = strip(c)
    return parse_by_kind(s, date_kind(s))


def date_kind(s: Column) -> Column:
    """1 for a stripped date with the year first, 2 for three numbers with the year last, 3 for any other text."""
    return F.when(s.rlike(YEAR_FIRST), 1).when(s.rlike(YEAR_LAST), 2).when(s.isNotNull(), 3)


def parse_by_kind(s: Column, kind: Column) -> Column:
    """``parse_sales_date`` of a stripped text and its ``date_kind``, which are used several times and best columns of their own."""
    year_first = F.replace(s, F.lit("/"), F.lit("-")).try_cast("date")  # what follows T or a space does not count
    dmy, mdy = (F.regexp_replace(s, YEAR_LAST_PARTS, order).try_cast("date") for order in ("$3-$2-$1", "$3-$1-$2"))
    year_last = F.when(s.contains("-"), F.coalesce(dmy, mdy)).otherwise(F.coalesce(mdy, dmy))
    return F.when(kind == 1, year_first).when(kind == 2, year_last).when(kind == 3, _let(s, _unusual))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; in a branch Spark would compute it at each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _unusual(s: Column) -> Column:
    """A date in one of the other layouts, by its signature."""
    def read(dated: Column, signature: Column, which: int) -> Column:
        iso = F.regexp_replace(dated, F.lit(PARTS), F.try_element_at(_table(which), signature))
        for year, whole in ((rf"^({TWO_DIGITS_2000})-", "20$1-"), (r"^(\d\d)-", "19$1-"), (r"^(\d)-", "200$1-")):
            iso = F.regexp_replace(iso, year, whole)
        return iso.try_cast("date")

    def by_layout(dated: Column) -> Column:
        plain = F.regexp_replace(dated, r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3")
        signature = F.concat(_signature(dated), F.when(s.rlike(TIME), "t").otherwise(""))
        read_any = _let(signature, lambda signed: F.coalesce(read(dated, signed, 0), read(dated, signed, 1)))
        return F.coalesce(read_any, F.when(dated.rlike(r"^\d{8}$"), plain.try_cast("date")))

    return _let(F.regexp_replace(_named(s), TIME, ""), by_layout)


def date_key_of(d: Column) -> Column:
    """``yyyymmdd`` integer key of a date."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
