"""Column builders shared by every layer.

All of them are native Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen and run on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes any Unicode whitespace and U+001C to U+001F;
# Spark's trim() only removes spaces.  (?U) makes \s Unicode-aware in Java regex.
_EDGE_WS = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"
# Decimal / scientific literal accepted as a number (after strip).
_NUMBER_RE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_INF_RE = r"^[+-]?(inf|infinity)$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Python-style strip of leading and trailing whitespace."""
    return F.regexp_replace(col(c), _EDGE_WS, "")


def parse_number(c: str | Column, strip_commas: bool = True) -> Column:
    """Lenient number parse: text, optional comma removal, bad -> NULL.

    NaN never gets in (it is NULL), infinities are kept.  ``try_cast`` alone
    would accept '1.0d' or 'nan', so a literal check guards it.
    """
    return number_of(number_text(c, strip_commas))


def number_text(c: str | Column, strip_commas: bool = True) -> Column:
    """The text that ``number_of`` takes; as a column of its own it is cleaned once a row."""
    text = col(c).cast("string")
    return strip(F.replace(text, F.lit(","), F.lit("")) if strip_commas else text)


def number_of(c: str | Column) -> Column:
    """The number that a cleaned text stands for."""
    text = col(c)
    finite = text.rlike(_NUMBER_RE)
    infinite = F.lower(text).rlike(_INF_RE)
    return (
        F.when(finite, text.try_cast("double"))
        .when(infinite, F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .otherwise(F.lit(None).cast("double"))
    )


def parse_int_or_zero(c: str | Column) -> Column:
    """Exponent parse: number, missing -> 0, truncated toward zero."""
    return whole_or_zero(parse_number(c, strip_commas=False))


def whole_or_zero(number: Column) -> Column:
    return F.coalesce(number.try_cast("int"), F.lit(0))


def parse_year(c: str | Column) -> Column:
    """Integer parse of a year-like text; anything else (also 2023.7) -> NULL."""
    n = parse_number(c, strip_commas=False)
    return F.when(n == F.floor(n), n.try_cast("int"))


def zfill2(c: str | Column) -> Column:
    """Left-pad to two characters with zeros; never truncates."""
    text = col(c).cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def after_first_dash(c: str | Column) -> Column:
    """Text after the first '-', or the whole text when there is none."""
    text = col(c).cast("string")
    pos = F.instr(text, "-")
    return F.when(pos > 0, text.substr(pos + 1, F.length(text))).otherwise(text)


def before_first_dash(c: str | Column) -> Column:
    return F.substring_index(col(c).cast("string"), "-", 1)


def period_parts(c: str | Column) -> dict[str, Column]:
    """Period text -> frequency ('A','M','Q',''), year, month, quarter.

    The patterns are fixed by the payloads.  The whole (stripped, upper-cased) text must match; \\z anchors at the true
    end so a trailing newline cannot slip through.
    """
    return parts_of_period(period_text(c))


def period_text(c: str | Column) -> Column:
    """The text that ``parts_of_period`` takes; as a column of its own it is cleaned once a row."""
    return F.upper(strip(col(c).cast("string")))


def parts_of_period(p: Column) -> dict[str, Column]:
    is_a = p.rlike(r"^\d{4}\z")
    is_m = p.rlike(r"^\d{4}M(0[1-9]|1[0-2])\z")
    is_q = p.rlike(r"^\d{4}Q[1-4]\z")
    freq = F.when(is_a, "A").when(is_m, "M").when(is_q, "Q").otherwise("")
    year = F.when(is_a | is_m | is_q, p.substr(1, 4).cast("int"))
    month = F.when(is_m, p.substr(6, 2).cast("int"))
    quarter = F.when(is_q, p.substr(6, 1).cast("int"))
    return {"frequency": freq, "year": year, "month": month, "quarter": quarter}


def period_code(freq: str | Column, year: str | Column, month: str | Column) -> Column:
    """Normalised period code: 'YYYY' for annual, 'YYYYMmm' for monthly."""
    return F.when(col(freq) == "M", F.format_string("%dM%02d", col(year), col(month))).otherwise(
        col(year).cast("string")
    )


def label_path(raw: str | Column) -> Column:
    """Series label -> array of hierarchy tiers.

    Strip, drop one leading '[...]' prefix, split on ':', strip each tier and
    drop blank tiers.
    """
    label = strip(F.coalesce(col(raw).cast("string"), F.lit("")))
    body = strip(F.regexp_replace(label, r"^\[[^\]]+\]\s*", ""))
    tiers = F.transform(F.split(body, ":"), lambda t: strip(t))
    return F.filter(tiers, lambda t: t != "")


def label_series_name(path: Column) -> Column:
    """First tier when the path has two or more tiers, else ''."""
    return F.when(F.size(path) >= 2, F.get(path, 0)).otherwise(F.lit(""))


def label_function_name(path: Column) -> Column:
    """Last tier when the path is non-empty, else ''."""
    return F.when(F.size(path) >= 1, F.element_at(path, -1)).otherwise(F.lit(""))


def _json_escape(x: Column) -> Column:
    x = F.replace(x, F.lit("\\"), F.lit("\\\\"))
    x = F.replace(x, F.lit('"'), F.lit('\\"'))
    x = F.replace(x, F.lit("\t"), F.lit("\\t"))
    x = F.replace(x, F.lit("\n"), F.lit("\\n"))
    x = F.replace(x, F.lit("\r"), F.lit("\\r"))
    x = F.replace(x, F.lit("\b"), F.lit("\\b"))
    x = F.replace(x, F.lit("\f"), F.lit("\\f"))
    # all else outside of printable ASCII as \uXXXX, beyond the basic plane as a pair of surrogates
    def coded(c: Column) -> Column:
        point = F.ascii(c)
        over = point - 0x10000
        pair = F.format_string("\\u%04x\\u%04x", F.lit(0xD800) + F.shiftright(over, 10),
                               F.lit(0xDC00) + over.bitwiseAND(F.lit(0x3FF)))
        return F.when((point >= 32) & (point < 127), c).when(point < 0x10000, F.format_string("\\u%04x", point)
                                                             ).otherwise(pair)

    plain = F.array_join(F.transform(F.filter(F.split(x, ""), lambda c: c != ""), coded), "")
    return F.when(x.rlike(r"[^\x20-\x7E]"), plain).otherwise(x)


def json_text_list(path: Column) -> Column:
    """Array -> JSON list text in the '["a", "b"]' layout ('[]' when empty)."""
    body = F.array_join(F.transform(path, _json_escape), '", "')
    return F.when(F.size(path) == 0, F.lit("[]")).otherwise(F.concat(F.lit('["'), body, F.lit('"]')))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is NULL or 0."""
    d = col(den)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(col(num) / d)


def slugify(c: str | Column) -> Column:
    s = F.regexp_replace(F.lower(col(c)), r"[^a-z0-9]+", "-")
    return F.regexp_replace(s, r"^-+|-+$", "")
