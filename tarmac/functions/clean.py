"""Column -> Column cleaning and coercion expressions (no UDFs).

Every function here is a pure Catalyst expression, so it stays inside
whole-stage codegen and can be pushed around by the optimizer.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source system's conventions.
# The CSV null sentinel, and the texts pandas' CSV reader treats as missing
# by default (empty text included).
NULL_SENTINEL = "\\N"
CSV_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                   "n/a", "nan", "null"]
# Default text for a missing JSON field.
UNKNOWN = "Unknown"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1 -------------------------------------------------------------------------
def to_number(x) -> Column:
    """Coerce text to DOUBLE; anything unparsable becomes NULL."""
    return _c(x).try_cast("double")


# F2 / F3 / F14 ----------------------------------------------------------------
def to_timestamp_fmt(x, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parse text with an explicit format; bad text becomes NULL.

    The result is a wall-clock TIMESTAMP_NTZ, like a pandas timestamp."""
    return F.try_to_timestamp(_c(x), F.lit(fmt)).cast("timestamp_ntz")


def time_of_day(ts) -> Column:
    """``HH:mm:ss`` text of a timestamp (TIME is off by default in Spark 4.1)."""
    return F.date_format(_c(ts), "HH:mm:ss")


def date_to_ts_text(d) -> Column:
    """``yyyy-MM-dd`` date (or timestamp) -> ``yyyy-MM-ddT00:00:00`` text."""
    return F.concat(F.date_format(_c(d), "yyyy-MM-dd"), F.lit("T00:00:00"))


# F4 / F6 ---------------------------------------------------------------------
def null_sentinel(x, sentinel: str = NULL_SENTINEL) -> Column:
    """``\\N`` (or another sentinel) -> NULL."""
    return F.nullif(_c(x), F.lit(sentinel))


def csv_nulls(x, tokens: Iterable[str] = CSV_NULL_TOKENS) -> Column:
    """Null out the texts a pandas CSV read would have turned into NaN."""
    c = _c(x)
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def nan_to_null(x) -> Column:
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


# F5 ------------------------------------------------------------------------
def fill_zero(df, columns: Iterable[str]):
    """NULL -> 0 for numeric columns and '0' for text columns (F5, quirk Q22)."""
    types = dict(df.dtypes)
    out = df
    for c in columns:
        if c not in types:
            continue
        zero = F.lit("0") if types[c] == "string" else F.lit(0).cast(types[c])
        out = out.withColumn(c, F.coalesce(F.col(c), zero))
    return out


# F7 / F8 ---------------------------------------------------------------------
def duration_ms(x, legacy_float: bool = False) -> Column:
    """``M:SS.mmm`` or ``SS.mmm`` text -> milliseconds (BIGINT).

    Exact by default: the seconds part goes through DECIMAL(12,3), so
    ``1:10.040`` is 70040.  ``legacy_float=True`` reproduces the float
    arithmetic ``int((m*60 + s) * 1000)`` (``1:10.040`` -> 70039).
    """
    c = _c(x)
    has_min = c.contains(":")
    minutes = F.when(has_min, F.split_part(c, F.lit(":"), F.lit(1))).otherwise(F.lit("0"))
    secs = F.when(has_min, F.split_part(c, F.lit(":"), F.lit(2))).otherwise(c)
    if legacy_float:
        total = (minutes.try_cast("double") * 60 + secs.try_cast("double")) * 1000
        return total.cast("bigint")
    m = minutes.try_cast("bigint")
    s = secs.try_cast("decimal(12,3)")
    return m * 60000 + (s * 1000).cast("bigint")


def duration_seconds(x) -> Column:
    """``SS.sss`` or ``M:SS.sss`` -> seconds as DOUBLE (exact via DECIMAL)."""
    return (duration_ms(x) / F.lit(1000.0)).cast("double")


# F9 - F12 --------------------------------------------------------------------
# Text Spark's string -> integer cast accepts: optional sign, ASCII digits,
# surrounded by whitespace or ISO control characters (which the cast trims).
_PAD = r"[\p{javaWhitespace}\x00-\x1F\x7F-\x9F]*"
INTEGER_TEXT = rf"^{_PAD}[+-]?[0-9]+{_PAD}$"


def to_bigint(x) -> Column:
    """``try_cast(x AS BIGINT)`` with a regex pre-check.

    Same result for every input (overflow is still NULL), but text that is
    not an integer never reaches the cast, whose failure path is slow."""
    c = _c(x)
    return F.when(c.rlike(INTEGER_TEXT), c.try_cast("bigint"))


def trunc_int(x) -> Column:
    """Float text -> BIGINT, truncated toward zero (quirk Q9 stream form)."""
    return _c(x).try_cast("double").cast("bigint")


def strict_int(x) -> Column:
    """ANSI cast: raises on bad text (use inside a validated path only)."""
    return _c(x).cast("bigint")


def digits_only(x) -> Column:
    """Cast only all-digit text; anything else (``R``, ``D``, blanks) -> NULL."""
    c = _c(x)
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def safe_int(x) -> Column:
    """NULL for blank or invalid text, else BIGINT."""
    return to_bigint(F.nullif(_c(x), F.lit("")))


# F13 / F15 / F16 / F19 / F20 -----------------------------------------------------
def strip_z(x) -> Column:
    return F.replace(_c(x), F.lit("Z"), F.lit(""))


def compose_key(*parts, sep: str = "_") -> Column:
    """``a_b_c`` message key.  NULL parts are skipped (``concat_ws``)."""
    return F.concat_ws(sep, *[_c(p).cast("string") for p in parts])


def field_or_default(x, default=UNKNOWN) -> Column:
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(_c(x), d)


def json_field_or_default(text, path: str, default=UNKNOWN) -> Column:
    """Exact ``dict.get(k, default)`` on JSON text (quirk Q19): the default
    applies to a *missing* field only; an explicit JSON null stays NULL.
    Parsed as VARIANT, where a JSON null is a value, not an absence."""
    v = F.variant_get(F.parse_json(_c(text)), path, "variant")
    d = default if isinstance(default, Column) else F.lit(default)
    return (F.when(v.isNull(), d)
             .when(F.is_variant_null(v), F.lit(None).cast("string"))
             .otherwise(F.variant_get(v, "$", "string")))


def truthy_fallback(x, fallback, falsy: Iterable = ("",)) -> Column:
    """Python's ``a or b`` for text: NULL or a falsy value falls back."""
    c = _c(x)
    cond = c.isNull()
    for v in falsy:
        cond = cond | (c == F.lit(v))
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.when(cond, fb).otherwise(c)


def text_equals(x, text: str) -> Column:
    """Compare after ``str()``, as the reference does for rank ``'1'``."""
    return _c(x).cast("string") == F.lit(text)


# Money -------------------------------------------------------------------------
def exact_sum(x, scale: int = 2) -> Column:
    """Order-independent sum of 2-decimal money values, returned as DOUBLE.

    Summing doubles depends on evaluation order; summing DECIMAL does not, so
    a distributed sum equals the single-node one bit for bit.
    """
    return F.round(F.sum(_c(x).cast(f"decimal(18,{scale})")).cast("double"), scale)


def all_present(*cols) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & _c(c).isNotNull()
    return cond


def any_missing(*cols) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | _c(c).isNull()
    return cond


# ------------------------------------------------------- payloads of unknown shape
def payload_records(payload: Column, path: str) -> Column:
    """P14 / F22 on a VARIANT: the records at ``path`` if the payload is a whole document, else the payload
    itself as the only one.  A payload that is no JSON (a SQL NULL) has none."""
    listed = F.try_variant_get(payload, path, "array<variant>")
    return F.coalesce(listed, F.when(payload.isNotNull(), F.array(payload)), F.array().cast("array<variant>"))


def field_state(record: Column, path: str) -> Column:
    """F16 / F17 / Q19 on a VARIANT: ``missing``, ``null`` (a JSON null) or ``value``."""
    got = F.try_variant_get(record, path, "variant")
    return F.when(got.isNull(), "missing").when(F.is_variant_null(got), "null").otherwise("value")
