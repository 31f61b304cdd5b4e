"""Hash-based draws: the same value on every run, engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_key(*parts) -> Column:
    """Parts joined by ``|``; plain Python values are taken as literals, strings as column names."""
    return F.concat_ws("|", *[(col(p) if isinstance(p, (str, Column)) else F.lit(p)).cast("string") for p in parts])


def hex_word(key: Column, word: int = 0) -> Column:
    """The ``word``-th 32-bit word of md5(key) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1 + 8 * word, 8), 16, 10).cast("bigint")


def draw(*parts) -> Column:
    """32-bit non-negative draw."""
    return hex_word(text_key(*parts))


def unit(*parts) -> Column:
    """Draw in [0, 1)."""
    return draw(*parts) / F.lit(4294967296.0)


def token_bits(token: Column, bits: int = 64) -> list[Column]:
    """Bit columns (0/1) of md5(token), most significant first; beyond its 128 bits those of md5(token|1), md5(token|2) ..."""
    words = [hex_word(token if w < 4 else text_key(token, w // 4), w % 4) for w in range((bits + 31) // 32)]
    return [F.shiftright(words[i // 32], 31 - i % 32).bitwiseAND(F.lit(1)) for i in range(bits)]
