"""Column expressions and row digests.

Every function here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must match the reference for equal results.
# Text a pandas export writes for a missing value in d1 (``astype(str)``).
MISSING_TEXT = "nan"
# Whole-cell spellings of a missing value that d2's text conversion blanks.
BLANKED_TEXT = ("nan", "None")
# Separator of the distinct-value concatenation in d2 (file 1).
CONCAT_SEP = " + "
# Separator of the row-hash text.
HASH_SEP = "|"
# Units appended to displayed values of the clustering reports.
UNIT_EMISSIONS = " Mt"
UNIT_CONCENTRATION = " µg/m³"
# ---------------------------------------------------------------------------

# A number the way Python's float() reads it, once the text is split on '-':
# optional '+', digits with single '_' separators, optional fraction and
# exponent, surrounding whitespace. Letters (inf, nan, 2010d) never match.
_DIGITS = r"[0-9]+(_[0-9]+)*"
NUMBER_PATTERN = (
    r"^\s*[+]?(" + _DIGITS + r"(\.(" + _DIGITS + r")?)?|\.(" + _DIGITS + r"))"
    r"([eE][+]?" + _DIGITS + r")?\s*$"
)
# pandas.to_numeric additionally accepts a leading '-' and signed exponents.
SIGNED_NUMBER_PATTERN = (
    r"^\s*[+-]?(" + _DIGITS + r"(\.(" + _DIGITS + r")?)?|\.(" + _DIGITS + r"))"
    r"([eE][+-]?" + _DIGITS + r")?\s*$"
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1
def split_part(c, sep: str = "/", n: int = 1) -> Column:
    """n-th part of ``c`` split on a literal separator (1-based)."""
    return F.split_part(_c(c), F.lit(sep), F.lit(n))


# F2
def trim_lower(c) -> Column:
    return F.lower(F.trim(_c(c)))


# F3 is F.coalesce; F4 is F.md5; F5 is F.concat / F.concat_ws.

_DIGIT_CHARS = "0123456789"
_NUMBER_CHARS = _DIGIT_CHARS + "+-.eE \t"


def number_shaped(s: Column, extra: str = "") -> Column:
    """Only digits, sign, point, exponent and blanks, with at least one
    digit. A character-table check (``translate``), not a regex: this runs
    on every cell of every numeric column."""
    return ((F.length(F.translate(s, _NUMBER_CHARS + extra, "")) == 0)
            & (F.length(F.translate(s, _DIGIT_CHARS, "")) < F.length(s)))


# F6
def to_numeric_coerce(c) -> Column:
    """Text -> double, anything that is not a finite decimal number -> null.

    ``try_cast`` alone would accept 'inf', 'NaN' and Java suffixes such as
    '2010d'; those never pass the character check, so only number-shaped
    text reaches the cast."""
    s = _c(c).cast("string")
    return F.when(number_shaped(s), F.trim(s).try_cast("double"))


# F7
def text_null_to_empty(c) -> Column:
    """Text of a value; missing or whole-cell 'nan'/'None' -> ''."""
    s = _c(c).cast("string")
    return F.when(F.coalesce(s, F.lit(MISSING_TEXT)).isin(*BLANKED_TEXT), F.lit("")).otherwise(s)


# F8
def to_string_nan(c, missing: str = MISSING_TEXT) -> Column:
    """Text of a value; missing -> a literal marker (d1 writes 'nan')."""
    return F.coalesce(_c(c).cast("string"), F.lit(missing))


# F9 helpers
def to_int_or_zero(c, target: str = "bigint", from_text: bool = True) -> Column:
    """pandas ``to_numeric(errors='coerce').fillna(0).astype(int)``:
    invalid -> 0, fractions truncated toward zero."""
    num = to_numeric_coerce(c) if from_text else _c(c).cast("double")
    safe = F.when(F.abs(num) < F.lit(2.0 ** 31 if target == "int" else 9.2e18), num)
    return F.coalesce(safe.cast(target), F.lit(0).cast(target))


def truncate_int(c, target: str = "int") -> Column:
    """double -> int toward zero (``astype(int)``); null stays null."""
    return _c(c).cast("double").cast(target)


# F10
def nullif_zero(c) -> Column:
    return F.nullif(_c(c), F.lit(0))


# F11
def log1p(c) -> Column:
    return F.log1p(_c(c))


# F12
def unit_for(feature: str) -> str | None:
    """Unit suffix the reports attach to a feature name."""
    if "co2" in feature or "methane" in feature or "nitrous" in feature:
        return UNIT_EMISSIONS
    if "pm" in feature or "no2" in feature:
        return UNIT_CONCENTRATION
    return None


def round_with_unit(c, unit: str) -> Column:
    """Round half to even at 2 decimals (numpy's rule) and append a unit."""
    return F.concat(F.bround(_c(c), 2).cast("string"), F.lit(unit))


# F13
def map_values(c, mapping: dict) -> Column:
    """Small fixed dictionary lookup (cluster id -> name)."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return m[_c(c)]


# F14
def abs_error(y, yhat) -> Column:
    return F.abs(_c(y) - _c(yhat))


def sqrt_sq_error(y, yhat) -> Column:
    return F.sqrt(F.pow(_c(y) - _c(yhat), 2))


# F15
def is_distinct_from(a, b) -> Column:
    return ~_c(a).eqNullSafe(_c(b))


# ---------------------------------------------------------------------------
# Row digests
# ---------------------------------------------------------------------------

def hash_text(c, dtype: T.DataType | None = None) -> Column:
    """Stable, lossless text of a value for hashing.

    A double is written as its 53-bit integer mantissa, 'p' and its binary
    exponent: every value has a text of its own, and it doesn't depend on an
    engine's float printing (1.0E10 vs 10000000000.0). 0.0 and -0.0 are '0'.
    """
    col = _c(c)
    if not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.cast("string")
    x = col.cast("double")
    size, two = F.abs(x), F.lit(2.0)
    guess = F.floor(F.log2(size)).cast("int")  # may be off by one next to a power of two
    power = guess + F.when(size >= F.pow(two, guess + 1), 1).when(size < F.pow(two, guess), -1).otherwise(0)
    mantissa = (x / F.pow(two, power) * F.lit(2.0 ** 52)).cast("bigint")
    text = F.concat(mantissa.cast("string"), F.lit("p"), power.cast("string"))
    return (F.when(x.isNull(), F.lit(None).cast("string")).when(F.isnan(x), "nan").when(x == 0, "0")
            .when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf")).otherwise(text))


def row_hash(df, cols: list[str], coalesce_nulls: bool = True) -> Column:
    """md5 over '|'-joined text of the measures, null -> ''."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in cols:
        t = hash_text(c, types.get(c))
        parts.append(F.coalesce(t, F.lit("")) if coalesce_nulls else t)
    text = reduce(lambda a, b: F.concat(a, F.lit(HASH_SEP), b), parts)
    return F.md5(text)


def encoded_text(df, cols: list[str]) -> Column:
    """Row text for U7, a part per column, doubles last: '-;' for null, the
    text of a double and ';' (no double's text has a ';' or is '-'), and for
    other values their text's length, ':', the text and ';'. No two rows of
    values share a text. The doubles go through one function over an array, so
    the generated code doesn't grow with their number."""
    types = {f.name: f.dataType for f in df.schema.fields}
    doubles = [c for c in cols if isinstance(types.get(c), (T.DoubleType, T.FloatType))]
    close = lambda t: F.coalesce(F.concat(t, F.lit(";")), F.lit("-;"))
    texts = [hash_text(f"`{c}`", types.get(c)) for c in cols if c not in doubles]
    parts = [close(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts]
    if doubles:
        values = F.array(*[F.col(f"`{c}`").cast("double") for c in doubles])
        parts.append(F.array_join(F.transform(values, lambda x: close(hash_text(x, T.DoubleType()))), ""))
    return F.concat(*parts)


def fingerprint_value(df, cols: list[str]) -> Column:
    """60-bit value of a row's md5, summed order-free by U7."""
    h = F.md5(encoded_text(df, cols))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast(T.DecimalType(38, 0))


def key_bucket(df, keys: list[str], buckets: int) -> Column:
    """The part of a table, 0 to buckets - 1, that a key's row belongs to."""
    return (F.conv(F.substring(F.md5(encoded_text(df, keys)), 1, 7), 16, 10).cast("int") % buckets).cast("int")


# ---------------------------------------------------------------------------
# Sums that don't depend on the order of the rows
# ---------------------------------------------------------------------------
def limbs(c) -> list[Column]:
    """A double as five integers in units of 2**26, 1, 2**-26, 2**-52 and
    2**-78, cut towards zero: exact for all that has no bits under 2**-78, so
    from 2**-25 upwards. Values that are not finite or not under 2**60 give
    nulls. (Scaling by powers of two, integers cut from a number and what is
    left of it are exact. Casts cut, as a remainder of doubles is slow.)"""
    x = _c(c).cast("double")
    x = F.when(F.abs(x) < F.lit(2.0 ** 60), x)
    cut = lambda v: v.cast("bigint")
    scaled = lambda v, k: v * F.lit(2.0 ** k)
    limb = F.lit(1 << 26).cast("bigint")
    high, rest = cut(scaled(x, -26)), x - cut(x)
    third, deep = cut(scaled(rest, 26)), scaled(rest, 52)
    return [high, cut(x) - high * limb, third, cut(deep) - third * limb, cut(scaled(deep - cut(deep), 26))]


def from_limbs(sums: list[Column]) -> Column:
    """The double of the integer sums of limbs, added from the smallest up:
    equal sums always give the same bits."""
    total = None
    for k, s in zip((78, 52, 26, 0, -26), reversed(sums)):
        part = s.cast("double") * F.lit(2.0 ** -k)
        total = part if total is None else total + part
    return total


def exact_sum(c, over=None) -> Column:
    """Sum of doubles with the same bits for any order, partitioning and plan
    shape: integer sums of limbs, put together once. What ``limbs`` can't take
    (infinities, NaN, 2**60 and more) is added as doubles."""
    x = _c(c).cast("double")
    place = (lambda s: s.over(over)) if over is not None else (lambda s: s)
    total = from_limbs([place(F.sum(part)) for part in limbs(x)])
    wild = place(F.sum(F.when(~(F.abs(x) < F.lit(2.0 ** 60)), x)))
    return F.when(wild.isNull(), total).otherwise(wild + F.coalesce(total, F.lit(0.0)))


def exact_mean(c, over=None) -> Column:
    """``exact_sum`` over the number of values; null where there is none."""
    n = F.count(_c(c))
    return F.try_divide(exact_sum(c, over), n.over(over) if over is not None else n)
