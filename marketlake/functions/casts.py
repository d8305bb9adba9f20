"""Scalar column functions for landing and cleaning (S8-S10, C1/C4 pieces).

All are native Catalyst expressions (no Python UDF), safe under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's str.strip() removes by default
# (Unicode whitespace), as a string and as a Java/RE2 character class.
PY_WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
PY_WHITESPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# The whitespace Python's float()/int() skip around a number --
# the str.strip() set without the separators \x1c-\x1f, which they reject.
FLOAT_WHITESPACE_CHARS = "".join(ch for ch in PY_WHITESPACE_CHARS if ch not in "\x1c\x1d\x1e\x1f")
FLOAT_WHITESPACE = (
    r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# The text Python's float() accepts after stripping -- decimal
# digits with single underscores between them, optional fraction and
# exponent, or inf/infinity/nan, each with an optional sign.
_DIGITS = r"[0-9](_?[0-9])*"
FLOAT_TEXT = (
    rf"^[+-]?((({_DIGITS})?\.{_DIGITS}|{_DIGITS}\.?)([eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    ``btrim`` with an explicit character set: a character scan, no regex.
    """
    return F.btrim(_col(c), F.lit(PY_WHITESPACE_CHARS))


def clean_text(c: Column | str) -> Column:
    """``(x or '').strip().upper()``."""
    return F.upper(py_strip(F.coalesce(_col(c), F.lit(""))))


def blank_to_null(c: Column | str) -> Column:
    """``str(x).strip() or None`` for a nullable string."""
    stripped = py_strip(_col(c))
    return F.when(stripped != "", stripped)


#: Text with nothing but these characters is parsed as it stands (looked at for every number: ``translate`` and
#: ``btrim`` handle a text character by character and cost several times as much).
_PLAIN = r"\A[0-9+\-.eE]*\z"


def trim_number(c: Column | str) -> Column:
    """The text without the whitespace that Python's ``float`` skips around a number."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_PLAIN), text).otherwise(F.btrim(text, F.lit(FLOAT_WHITESPACE_CHARS)))


def parse_number(text: Column | str) -> Column:
    """The double that Python's ``float`` reads from trimmed text, else null.

    Plain text (digits, signs, point, exponent) goes to ``try_cast``, which
    agrees with Python on it; forms only Java reads (``12d``, ``1f``,
    ``0x1p3``, control characters) are not plain. The rest -- grouped digits,
    inf and nan -- is checked against the full grammar, the only regex here.
    """
    text = _col(text)
    return (
        F.when(text.rlike(_PLAIN), text.try_cast("double"))
        .when(text.rlike(FLOAT_TEXT), F.when(text.rlike("(?i)nan$"), F.lit(float("nan"))).otherwise(
            F.replace(text, F.lit("_"), F.lit("")).try_cast("double")))
    )


def safe_float(c: Column | str) -> Column:
    """Null, blank or unparsable text -> null, else the double value.

    Exactly the strings Python's ``float`` accepts (surrounding whitespace
    as ``float`` skips it, which excludes \\x1c-\\x1f). For many columns at
    once see ``trim_numbers``, which trims in a projection of its own.
    """
    return parse_number(trim_number(c))


def trim_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` with the named text columns as ``trim_number`` leaves them.

    Trimming in one projection and parsing in the next keeps the generated
    code small: each trimmed text is computed once, not in every branch.
    """
    return df.withColumns({c: trim_number(c) for c in columns})


def safe_int(c: Column | str) -> Column:
    """``int(float(x))`` -- parse as float, truncate toward zero."""
    return safe_float(c).try_cast("bigint")


def python_float_text(c: Column | str) -> Column:
    """``str(x)`` of a Python float: no exponent from 1e-4 up to 1e16 (Spark has one from 1e7)."""
    x = _col(c)
    size = F.abs(x)
    plain = F.rtrim(x.cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    odd = ((size >= 1e7) & (size < 1e16)) | ((size < 1e-3) & (size >= 1e-4))
    return F.when(odd, plain).otherwise(x.cast("string"))


def comma_float(c: Column | str) -> Column:
    """``float(str(x).replace(',', ''))`` -> null when unparsable."""
    return safe_float(F.replace(_col(c).cast("string"), F.lit(","), F.lit("")))


def comma_int(c: Column | str) -> Column:
    """Integer twin of S10."""
    return comma_float(c).try_cast("bigint")


def non_negative(c: Column | str) -> Column:
    """Clamp a negative price to null; zero and NaN are kept (NaN sorts above
    every number in Spark, so ``NaN >= 0`` holds)."""
    x = _col(c)
    return F.when(x >= 0, x)


def truthy_text(c: Column | str) -> Column:
    """Python truthiness of an optional string: not null and not empty."""
    x = _col(c)
    return x.isNotNull() & (x != "")
