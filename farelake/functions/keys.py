"""Row hash (C1, L2, L17) and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schema as S


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: both ends, every Unicode whitespace char (L2).

    ``btrim`` with a character set allocates per call, so it only runs when
    the first or last character is whitespace (a search in some 60 bytes).
    """
    ws = F.lit(S.PY_WHITESPACE)
    edge = F.contains(ws, F.substring(c, 1, 1)) | F.contains(ws, F.substring(c, -1, 1))
    return F.when(edge, F.btrim(c, ws)).otherwise(c)


def _fits(dtype: T.DataType | None) -> bool:
    """Whether the type's values all fit the money type, digit for digit."""
    return (isinstance(dtype, T.DecimalType) and dtype.scale <= S.MONEY.scale
            and dtype.precision - dtype.scale <= S.MONEY.precision - S.MONEY.scale)


def canonical_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Canonical text of a number, given as a number or as text (T5).

    1, 1.0 and 1.000000 all give ``1.000000``, so no engine-specific float
    formatting leaks in. A value with more than 6 decimals or 12 integer
    digits keeps all of up to 18 decimals and 20 integer digits, and one
    beyond even that its own text, so different numbers stay different. The
    wide cast runs only for values of which the short one may lose a digit:
    by the declared type, by the way back to a double, or by the text's form.
    """
    short, full, text = c.try_cast(S.MONEY), c.try_cast("decimal(38,18)"), c.cast("string")
    if _fits(dtype):
        return short.cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        lossless = short.cast(dtype) == c
    else:
        lossless = text.rlike(r"^-?[0-9]{1,11}(\.[0-9]{1,6})?$") | (short == full)
    return F.when(lossless, short.cast("string")).otherwise(F.coalesce(full.cast("string"), strip_ws(text)))


def canonical_text(c: Column, dtype: T.DataType, numeric: bool = False) -> Column:
    """Canonical text of one value for hashing.

    Numbers, and with ``numeric`` text that declares a number, render through
    :func:`canonical_number`; other text is stripped of surrounding
    whitespace; NULL becomes the null token.
    """
    if numeric or isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        text = canonical_number(c, None if numeric else dtype)
    elif isinstance(dtype, T.StringType):
        text = strip_ws(c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(S.HASH_NULL))


def row_hash(df, columns=S.ENGINE_COLUMNS, numeric=(), canonical=()) -> Column:
    """MD5 hex of the canonical values of ``columns`` joined by ``|``.

    ``numeric`` names text columns that hold numbers: hashing their text
    keeps digits that the typed column would round away. ``canonical`` names
    those that hold :func:`canonical_number` already.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.coalesce(F.col(f"`{c}`"), F.lit(S.HASH_NULL)) if c in canonical
             else canonical_text(F.col(f"`{c}`"), types[c], c in numeric) for c in columns]
    return F.md5(F.concat_ws(S.HASH_SEPARATOR, *parts))


def hash_bytes(hash_column: str) -> Column:
    """A hash's 32 hexadecimal digits as the 16 bytes that they spell; different values stay different, and null stays null.

    Any other text, in which case must not matter, stands for itself behind
    17 spaces, which no 16 bytes can be.
    """
    text = F.col(hash_column)
    return F.when(text.rlike(r"^[0-9a-f]{32}\z"), F.unhex(text)).otherwise(F.concat(F.lit(" " * 17), text).cast("binary"))


def hash_text(hash_column: str) -> Column:
    """The text of :func:`hash_bytes`."""
    spelled = F.col(hash_column)
    return F.when(F.octet_length(spelled) == 16, F.lower(F.hex(spelled))).otherwise(F.substring(spelled.cast("string"), 18, 2**31 - 1))


def surrogate_key(*cols) -> Column:
    """MD5 surrogate key over one or more columns, NULL-safe."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                        F.lit(S.KEY_NULL)) for c in cols]
    text = parts[0] if len(parts) == 1 else F.concat_ws(S.KEY_SEPARATOR, *parts)
    return F.md5(text)
