"""Scalar string, number, date and JSON helpers.

All helpers return ``Column`` expressions built from Spark's built-in
functions, so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.isspace()`` accepts (what
# ``str.strip()``/``str.split()`` treat as whitespace) are Java's
# ``Character.isWhitespace`` set plus \x85, \xA0, \u2007 and \u202F.  The class
# below equals Python's set over every code point (checked in the tests);
# Java's ``(?U)\s`` would miss \x1C-\x1F.
WS_CLASS = r"[\p{javaWhitespace}\x85\xA0\u2007\u202F]"
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def quote_regex(literal: str) -> str:
    """Quote a literal delimiter for Spark's regex-based ``split``."""
    return r"\Q" + literal.replace(r"\E", r"\E\\E\Q") + r"\E"


def strip_ws(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace."""
    return F.regexp_replace(_c(col), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def split_ws(col) -> Column:
    """Python ``str.split()``: split on whitespace runs, no empty strings.

    Only a leading or trailing run can produce an empty piece, so the pieces
    are filtered instead of stripping the whole text first (one regex pass)."""
    return F.filter(F.split(_c(col), f"{WS_CLASS}+"), lambda x: x != F.lit(""))


def split_on(col, delimiter: str) -> Column:
    """Python ``str.split(delimiter)``: literal delimiter, empties kept."""
    return F.split(_c(col), quote_regex(delimiter))


def remove_literal(col, literal: str) -> Column:
    """Literal replace with nothing (R10, the thousands comma)."""
    return F.replace(_c(col), F.lit(literal), F.lit(""))


def text_stats(col) -> dict[str, Column]:
    """Word count and characters that are not whitespace."""
    words = split_ws(col)
    return {
        "n_words": F.size(words),
        "n_chars_no_ws": F.length(F.array_join(words, "")),
    }


# Printf-style conversions understood by ``format_ratio``.
FORMAT_SPECIFIERS = ("f", "e", "s", "g")  # a ratio is a double: no integer conversions


def format_ratio(col, divisor: float, fmt: str = "%.2fh") -> Column:
    """``fmt % (col / divisor)``; an unknown conversion raises at once."""
    spec = re.findall(r"%[-+ 0#]*\d*(?:\.\d+)?([a-zA-Z])", fmt)
    if not spec or any(s not in FORMAT_SPECIFIERS for s in spec):
        raise ValueError(f"unsupported format specifier in {fmt!r}")
    return F.format_string(fmt, _c(col) / F.lit(divisor))


def py_repr_str(col) -> Column:
    """Python ``repr`` of a string: single quotes unless the text holds a
    single quote and no double quote; backslashes doubled, line breaks and
    tabs escaped; NULL gives ``None``."""
    c = _c(col).cast("string")
    escaped = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    use_double = c.contains("'") & ~c.contains('"')
    return F.when(c.isNull(), F.lit("None")).when(
        use_double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))


def py_str(col) -> Column:
    """Python ``str`` of a value's text: NULL gives ``None``."""
    return F.coalesce(_c(col).cast("string"), F.lit("None"))


def to_string_kv(k, v, delimiter: str = ",") -> Column:
    """P10 ``ToString.Kvs``: ``"k<delim>v"``."""
    return F.concat_ws(delimiter, py_str(k), py_str(v))


def to_string_tuple(*cols) -> Column:
    """P10 ``ToString.Element`` of a 2-tuple of strings: ``"('a', 'b')"``."""
    parts = [py_repr_str(c) for c in cols]
    inner = F.concat_ws(", ", *parts)
    if len(parts) == 1:
        inner = F.concat(inner, F.lit(","))
    return F.concat(F.lit("("), inner, F.lit(")"))


def to_string_iterable(*cols, delimiter: str = ",") -> Column:
    """P10 ``ToString.Iterables``: fields joined by the delimiter."""
    return F.concat_ws(delimiter, *[py_str(c) for c in cols])


def _epoch_ntz() -> Column:
    return F.expr(EPOCH_NTZ)


def epoch_seconds_ntz(col) -> Column:
    """Whole seconds since the epoch of a TIMESTAMP_NTZ (time-zone free)."""
    return F.timestamp_diff("SECOND", _epoch_ntz(), _c(col))


def epoch_micros_ntz(col) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(col))


def ntz_from_seconds(col) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock), time-zone free."""
    return F.timestamp_add("SECOND", _c(col), _epoch_ntz())


def ntz_to_ltz(col) -> Column:
    """TIMESTAMP_NTZ read as UTC -> TIMESTAMP, independent of the session zone
    (needed by ``withWatermark``, which rejects NTZ)."""
    return F.timestamp_micros(epoch_micros_ntz(col))


def ltz_to_ntz(col) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ in UTC wall clock, session-zone free."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), _epoch_ntz())


def python_datetime_str(ts_ntz) -> Column:
    """``str(datetime)``: fraction printed only when it is not zero."""
    c = _c(ts_ntz)
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    frac = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.when(F.pmod(epoch_micros_ntz(c), F.lit(1000000)) == 0,
                  whole).otherwise(frac)


def event_time_label(seconds, name) -> Column:
    """``"<utc datetime>-<name>"`` from epoch seconds."""
    return F.concat_ws("-", F.coalesce(python_datetime_str(ntz_from_seconds(seconds)), F.lit("None")), py_str(name))


def logical_clock_label(clock, name) -> Column:
    """``"<int>-<name>"`` from a logical clock."""
    return F.concat_ws("-", py_str(_c(clock).cast("bigint")), py_str(name))


def parse_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    """Invalid text -> NULL instead of an error."""
    return F.try_to_date(_c(col), fmt)


def parse_timestamp(col, fmt: str | None = None) -> Column:
    """``%Y-%m-%d %H:%M:%S.%f`` style text; invalid -> NULL."""
    c = _c(col)
    if fmt is None:
        return F.try_to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt))


def iso_datetime(col) -> Column:
    """``datetime.isoformat()`` for whole-second values."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss")


def window_label(value, start, end) -> Column:
    """``"<value>  [<start> - <end>]"`` (two spaces)."""
    return F.format_string("%s  [%s - %s]", _c(value).cast("string"),
                           python_datetime_str(start), python_datetime_str(end))


def number_text_ok(col) -> Column:
    """True when the (already comma-fixed) text is a plain decimal number.

    ``try_cast`` alone also accepts ``1d``, ``nan`` and ``inf``; this grammar
    keeps to digits, one optional point and an optional exponent.
    """
    return _c(col).rlike(r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$")
