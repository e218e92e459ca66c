"""What a string cell holds: integer, real, date/time, text, or none of them.

Numbers are recognised by an anchored pattern first, so Java-only spellings such as
`1.5d` are not read as numbers. Dates are brought to `yyyy-m-d h:m:s` by a chain of
anchored rewrites and cast once; a value no rewrite fits stays as it is and casts to null.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from colsight.functions.text import let

# --- fixed values: what counts as a number ------------------------------------------
INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
REAL_PATTERN = r"^\s*[+-]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
NUMERIC_PATTERN = (
    r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf(inity)?|nan)\s*$"
)

# --- fixed values: shapes that make a value worth parsing as a date -------------------
# `{}` is the separator: dash, slash or blank.
DATE_SHAPES = (
    r"[0-9]{{2}}{0}[0-9]{{2}}{0}[0-9]{{4}}",
    r"[0-9]{{4}}{0}[0-9]{{2}}{0}[0-9]{{2}}",
    r"[0-9]{{2}}{0}[0-9]{{2}}{0}[0-9]{{2}}",
    r"[0-9]{{2}}{0}[0-9]{{4}}",
    r"[0-9]{{4}}{0}[0-9]{{2}}",
    r"[0-9]{{2}}{0}[a-zA-Z]{{3}}",
    r"[a-zA-Z]{{3}}{0}[0-9]{{2}}",
)
HIGH_GATE = "|".join(s.format(sep) for sep in ("-", "/", " ") for s in DATE_SHAPES) + "|:"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_ANY = "|".join(MONTHS)
MONTH_NAME = (
    r"jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    r"sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
WEEKDAY = r"^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]{0,6}\.?,? {1,2}"
ZONE = r" ?(?:z|utc|gmt)$"
HALF_DAY = r" ?([ap])\.?m\.?$"
# zone names that don't say one offset everywhere: the time is taken as it stands
ZONE_NAME = r"(:[0-9]{2}(?:\.[0-9]+)?(?: ?[ap]\.?m\.?)?) (?:[ecmp][sd]?t|cest|cet|bst|ist|jst)$"
# other spellings of a time -> h:m[:s]
TIMES = (
    (r"(^|[ ,t])([0-9]{1,2}) ?([ap]\.?m\.?)$", "$1$2:00 $3"),
    (r"(^|[ ,t])([0-9]{1,2}) ?h ?([0-9]{2}) ?m? ?([0-9]{2}) ?s$", "$1$2:$3:$4"),
    (r"(^|[ ,t])([0-9]{1,2}) ?h ?([0-9]{2}) ?m?$", "$1$2:$3"),
    (r"^([0-9]{8}[t ])([0-9]{2})([0-9]{2})([0-9]{2})$", "$1$2:$3:$4"),
    (r"^([0-9]{8}t)([0-9]{2})([0-9]{2})$", "$1$2:$3"),
)
# a zone offset after a time; the time is group 1
OFFSET = r"(:[0-9]{2}(?:\.[0-9]+)?(?: ?[ap]\.?m\.?)?) ?(?:z|utc|gmt)?([+-])([0-9]{2}):?([0-9]{2})?$"

# --- rewrites to `~year-month-day time`, in order; a rewritten value matches no later one ---
# A month name has become `<nn>` before. The day comes first only where the first number
# cannot be a month. Without a year it is 1970, so no result depends on the day of the run.
_REST = r"(?:t| {0,2},? {0,2}| at )([0-9]{1,2}:.*)?$"
_SEP = r"[-/ .]"
_GAP = r"[-/ ,.]{0,3}"
_OF = r"(?:[-/ ,.]{0,3}| of )"
_ORD = r"(?:st|nd|rd|th)?"
_YEAR = r"([0-9]{4}|[0-9]{2})"
_NUM = r"([0-9]{1,2})"
_MON = r"<([0-9]{2})>"
LAYOUTS = (
    (f"^([0-9]{{4}}){_SEP}{_NUM}{_SEP}{_NUM}{_REST}", "~$1-$2-$3 $4"),
    (f"^(1[3-9]|2[0-9]|3[01]){_SEP}(0?[1-9]|1[0-2]){_SEP}{_YEAR}{_REST}", "~$3-$2-$1 $4"),
    (f"^{_NUM}{_SEP}{_NUM}{_SEP}{_YEAR}{_REST}", "~$3-$1-$2 $4"),
    (f"^(?:the )?{_NUM}{_ORD}{_OF}{_MON}{_GAP}{_YEAR}{_REST}", "~$3-$2-$1 $4"),
    (f"^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})[t ]([0-9]{{2}}:.*)$", "~$1-$2-$3 $4"),
    (f"^{_MON}{_GAP}{_NUM}{_ORD},? {{1,2}}([0-9]{{1,2}}:[0-9:.]+) (?:[a-z]{{3,4}} )?([0-9]{{4}})$", "~$4-$1-$2 $3"),
    (f"^{_MON}{_GAP}([0-9]{{4}})$", "~$2-$1-01 "),
    (f"^{_MON}{_GAP}{_NUM}{_ORD}[-/ ,.]{{1,3}}{_YEAR}{_REST}", "~$3-$1-$2 $4"),
    (f"^([0-9]{{4}}){_GAP}{_MON}{_GAP}{_NUM}{_ORD}{_REST}", "~$1-$2-$3 $4"),
    (f"^([0-9]{{4}}){_GAP}{_MON}$", "~$1-$2-01 "),
    (r"^([0-9]{4})[-/]([0-9]{1,2})$", "~$1-$2-01 "),
    (r"^([0-9]{1,2})[-/]([0-9]{4})$", "~$2-$1-01 "),
    (f"^{_MON}{_GAP}{_NUM}{_ORD}$", "~1970-$1-$2 "),
    (f"^{_NUM}{_ORD}{_GAP}{_MON}$", "~1970-$2-$1 "),
    (r"^([0-9]{1,2}:.*)$", "~1970-01-01 $1"),
)
# two-digit years, unless a column says otherwise
CENTURIES = ((r"^~([0-5][0-9]|6[0-8])-", "~20$1-"), (r"^~([0-9]{2})-", "~19$1-"))
CANONICAL = r"^~[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} ([0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"


def numeric_like(c: Column) -> Column:
    return c.rlike(NUMERIC_PATTERN)


def interpret_int(c: Column) -> Column:
    return F.when(c.rlike(INT_PATTERN), F.trim(c).try_cast("bigint"))


def interpret_real(c: Column) -> Column:
    return F.when(c.rlike(REAL_PATTERN), F.trim(c).try_cast("double"))


def _low(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), WEEKDAY, ""), ZONE, ""), ZONE_NAME, "$1")


def _bare(low: Column) -> Column:
    return reduce(lambda acc, rule: F.regexp_replace(acc, rule[0], rule[1]), TIMES, F.regexp_replace(low, OFFSET, "$1"))


def _half_day(bare: Column) -> Column:
    return F.regexp_extract(bare, HALF_DAY, 1)


def rewritten(bare: Column) -> Column:
    """`~year-month-day time`, two-digit years as they are."""
    no_half = F.regexp_replace(bare, HALF_DAY, "")
    month = F.regexp_extract(bare, f"(^|[^a-z])({MONTH_ANY})", 2)
    number = F.lpad(((F.instr(F.lit("".join(MONTHS)), month) + 2) / 3).cast("int").cast("string"), 2, "0")
    named = F.regexp_replace(
        no_half, F.lit(f"(^|[^a-z])(?:{MONTH_NAME})([^a-z]|$)"), F.concat(F.lit("$1<"), number, F.lit(">$2"))
    )
    return reduce(lambda acc, rule: F.regexp_replace(acc, rule[0], rule[1]), LAYOUTS, named)


def in_century(raw: Column) -> Column:
    return reduce(lambda acc, rule: F.regexp_replace(acc, rule[0], rule[1]), CENTURIES, raw)


def _iso(bare: Column) -> Column:
    return in_century(rewritten(bare))


def _timestamp(iso: Column) -> Column:
    """Digits beyond microseconds are cut."""
    micros = F.regexp_replace(F.regexp_replace(iso, r"(\.[0-9]{6})[0-9]+$", "$1"), "^~", "")
    return F.when(iso.rlike(CANONICAL), F.trim(micros).try_cast("timestamp_ntz"))


def _to_utc(ts: Column, low: Column) -> Column:
    """A time with an offset, in UTC; null for an offset that no zone has."""
    sign, hours, minutes = (F.regexp_extract(low, OFFSET, i) for i in (2, 3, 4))
    shift = F.try_to_number(hours, F.lit("99")) * 60 + F.coalesce(F.try_to_number(minutes, F.lit("99")), F.lit(0))
    moved = F.when(sign == "-", shift).otherwise(-shift).cast("int")
    return F.when(sign == "", ts).when((shift <= 18 * 60) & (F.coalesce(F.try_to_number(minutes, F.lit("99")), F.lit(0)) < 60), F.timestamp_add("MINUTE", moved, ts))


def _apply_half(ts: Column, half: Column) -> Column:
    hour = F.hour(ts)
    return (
        F.when(half == "", ts)
        .when((hour > 12) | (hour == 0), F.lit(None))
        .when((half == "p") & (hour < 12), ts + F.expr("INTERVAL 12 HOURS"))
        .when((half == "a") & (hour == 12), ts - F.expr("INTERVAL 12 HOURS"))
        .otherwise(ts)
    )


def parse_datetime(c: Column) -> Column:
    """Timestamp without zone, or null; times with an offset are brought to UTC. Does not check
    whether the value looks like a date."""

    def read(low: Column) -> Column:
        def of(bare: Column) -> Column:
            return let(_timestamp(let(bare, _iso)), lambda ts: _apply_half(ts, _half_day(bare)))

        return let(let(_bare(low), of), lambda ts: _to_utc(ts, low))

    return let(_low(c), read)


def _occurrences(c: Column, ch: str) -> Column:
    return F.char_length(c) - F.char_length(F.replace(c, F.lit(ch)))


def date_gate(c: Column, level: str = "high") -> Column:
    """Is the value worth parsing? `high`, `moderate` and `low` are looser in this order."""
    if level == "high":
        looks = c.rlike(HIGH_GATE)
    elif level == "moderate":
        dashes, colons, slashes = (_occurrences(c, ch) for ch in "-:/")
        month = F.lower(c).rlike(MONTH_ANY)
        looks = (month & dashes.between(1, 2)) | (dashes == 2) | colons.between(1, 2) | (slashes == 2)
    elif level == "low":
        looks = c != ""
    else:
        raise ValueError(f"unknown level {level!r}")
    return looks & ~numeric_like(c)


def interpret_datetime(c: Column, level: str = "high") -> Column:
    return F.when(date_gate(c, level), parse_datetime(c))


def interpret_text(c: Column, level: str = "high") -> Column:
    return F.when(~numeric_like(c) & interpret_datetime(c, level).isNull(), c)


def with_bare(df: DataFrame, source: str = "val", level: str = "high") -> DataFrame:
    """Adds `_low` and `_bare`: values worth parsing as dates, without and with their times' spelling unified."""
    c = F.col(source)
    return df.withColumn("_low", F.when(date_gate(c, level), _low(c))).withColumn("_bare", _bare(F.col("_low")))


def with_interpretation(df: DataFrame, source: str = "val", level: str = "high", settle: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add as_int, as_real, as_ts and kind.

    kind is int, real, date, text, or unclassified: a number that is neither a plain
    integer nor a real with a point (`1e5`, `nan`, integers beyond 64 bits). `settle` brings
    `_bare` to `_iso` where more than the value decides how; see `operators.dates.settled`.
    """
    c = F.col(source)
    # one step per column: each is used more than once further on, so Catalyst keeps the
    # projections apart, evaluates each step once and can compile them all
    bare = with_bare(df.withColumns({"as_int": interpret_int(c), "as_real": interpret_real(c)}), source, level)
    parsed = (
        (settle(bare) if settle else bare.withColumn("_iso", _iso(F.col("_bare"))))
        .withColumn("_ts", _timestamp(F.col("_iso")))
        .withColumn("as_ts", _to_utc(_apply_half(F.col("_ts"), _half_day(F.col("_bare"))), F.col("_low")))
        .drop("_low", "_bare", "_iso", "_ts")
    )
    kind = (
        F.when(c.isNull(), F.lit(None))
        .when(F.col("as_int").isNotNull(), "int")
        .when(F.col("as_real").isNotNull(), "real")
        .when(F.col("as_ts").isNotNull(), "date")
        .when(numeric_like(c), "unclassified")
        .otherwise("text")
    )
    return parsed.withColumn("kind", kind)
