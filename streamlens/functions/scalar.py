"""Column-level helpers.

Everything here returns a ``Column`` made of built-in expressions so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one-hash bitmap of the unique-visitor job multiplies by 61 per
# character and keeps the low 16 bits (a 65,536-bit map per window).
HASH_MULTIPLIER = 61
HASH_BITS = 16

# Tokeniser pattern (one or more non-word characters).
WORD_SPLIT = r"\W+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def poly_hash(s, multiplier: int = HASH_MULTIPLIER, bits: int = HASH_BITS) -> Column:
    """``h = h * multiplier + code(ch)`` over the characters, kept to ``bits`` bits.

    Masking at each step equals masking a 32-bit wrapping result at the end, as
    2^bits divides 2^32.
    """
    s = _col(s)
    mask = (1 << bits) - 1
    codes = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
                        lambda i: F.ascii(F.substring(s, i, 1)).cast("long"))
    codes = F.when(F.length(s) > 0, codes).otherwise(F.array().cast("array<long>"))
    return F.aggregate(codes, F.lit(0).cast("long"),
                       lambda acc, c: (acc * multiplier + c).bitwiseAND(F.lit(mask)))


def timestamp_text(ts) -> Column:
    """Render like ``java.sql.Timestamp.toString`` for whole-second values: ``yyyy-MM-dd HH:mm:ss.0``."""
    return F.concat(F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss"), F.lit(".0"))

