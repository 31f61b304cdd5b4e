"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import col


def strip_non_ascii(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"[^\x00-\x7F]", "")


def strip_punct(c: Column | str) -> Column:
    """Remove all 32 ASCII punctuation marks."""
    return F.regexp_replace(col(c), r"\p{Punct}", "")


def strip_edge_punct(c: Column | str) -> Column:
    """Remove ASCII punctuation at both ends only."""
    return F.regexp_replace(col(c), r"^\p{Punct}+|\p{Punct}+$", "")


def words(c: Column | str, min_len: int = 1) -> Column:
    """Whitespace tokens of at least ``min_len`` characters."""
    return F.filter(F.split(col(c), r"\s+"), lambda w: F.length(w) >= min_len)


def tokens(c: Column | str, sep: str = " ", min_len: int = 0) -> Column:
    """Lower-cased tokens. ``sep=' '`` splits on single blanks and keeps empty tokens; ``None`` splits on whitespace."""
    raw = F.split(col(c), " ", -1) if sep == " " else words(c)
    kept = F.filter(raw, lambda w: F.length(w) >= min_len) if min_len else raw
    return F.transform(kept, F.lower)


def lexicon_tokens(c: Column | str) -> Column:
    """Tokens as looked up in a polarity lexicon: ASCII only, split on blanks, no punctuation, lower case."""
    return F.transform(F.split(strip_non_ascii(c), " ", -1), lambda w: F.lower(strip_punct(w)))


def extract_ints(c: Column | str) -> Column:
    """All digit runs as bigints."""
    return F.transform(F.regexp_extract_all(col(c), F.lit(r"([0-9]+)"), F.lit(1)), lambda x: x.try_cast("bigint"))


def to_utf8(c: Column | str) -> Column:
    return F.encode(col(c), "UTF-8")


def from_utf8(c: Column | str) -> Column:
    return F.decode(col(c), "UTF-8")


def round_rating(c: Column | str) -> Column:
    """Round half away from zero to a bigint."""
    return F.round(col(c).cast("double"), 0).cast("bigint")
