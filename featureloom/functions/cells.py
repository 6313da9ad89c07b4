"""Column expressions for cleaning single cells. All are Catalyst built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that count as missing in a delimited table.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters a record key must not contain; each becomes "_".
KEY_FORBIDDEN = "*&^%$@!~#()[]{}?/\\"

# A float literal, and one written with a decimal comma.
FLOAT_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DECIMAL_COMMA_PATTERN = r"^\s*[+-]?(\d+,\d*|,\d+)([eE][+-]?\d+)?\s*$"

# Fixed value: an escape sequence (C1 function or CSI with parameters).
ANSI_PATTERN = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[-/]*[@-~])"

_OUTER_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(name: str) -> Column:
    """Column of exactly this name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_decimal_comma(c) -> Column:
    """True where the cell is a number written with one comma and no dot."""
    return F.coalesce(_col(c).rlike(DECIMAL_COMMA_PATTERN), F.lit(False))


def fix_decimal_comma(c) -> Column:
    """Swap the decimal comma for a dot; every other cell is left as it is."""
    c = _col(c)
    return F.when(is_decimal_comma(c), F.translate(c, ",", ".")).otherwise(c)


def clean_key(c) -> Column:
    """Strip the key, delete blanks and tabs, replace forbidden characters by ``_``."""
    pattern = f"^{_OUTER_SPACE}+|{_OUTER_SPACE}+$|[ \\t]"
    squeezed = F.regexp_replace(_col(c), pattern, "")
    return F.translate(squeezed, KEY_FORBIDDEN, "_" * len(KEY_FORBIDDEN))


def null_token(c, tokens=NA_TOKENS) -> Column:
    """Null where the cell is one of the missing-value strings."""
    c = _col(c)
    return F.when(c.isin(*tokens), F.lit(None)).otherwise(c)


def to_double(c) -> Column:
    """Number in the cell, or null where the text is no finite float literal."""
    c = _col(c).cast("string")
    return F.when(c.rlike(FLOAT_PATTERN), F.trim(c).try_cast("double"))


def strip_stereo(c) -> Column:
    """Drop the stereo marks ``@``, ``/`` and ``\\`` of a line notation."""
    return F.translate(_col(c), "@/\\", "")


def strip_ansi(c) -> Column:
    """Drop terminal escape sequences."""
    return F.regexp_replace(_col(c), ANSI_PATTERN, "")


def format_shift(c, digits: int = 2) -> Column:
    """Value at a fixed number of decimals, half up; null stays null."""
    return F.round(_col(c).cast("double"), digits)
