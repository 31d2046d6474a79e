"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def null_to_empty(col: Column) -> Column:
    """Trimmed text of any value, NULL as the empty string."""
    return F.trim(F.coalesce(col.cast("string"), F.lit("")))


def joined_key(*cols: Column) -> Column:
    """Key parts joined by ``_``; NULL when any part is NULL."""
    texts = [c.cast("string") for c in cols]
    return F.concat(*[p for i, t in enumerate(texts) for p in ((F.lit("_"), t) if i else (t,))])


def sorted_set(col: Column, sep: str = ",") -> Column:
    """Aggregate: the distinct values of a group, sorted and joined."""
    return F.concat_ws(sep, F.sort_array(F.collect_set(col)))


def lookup(mapping: dict, key: Column) -> Column:
    """Value of a literal map; a missing key gives NULL."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key)


def padded_key(number: Column, width: int = 8) -> Column:
    """Zero-padded decimal text; a number that is already wider keeps all its digits."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def salted_key(key: Column, buckets: int = 99) -> Column:
    """Two-digit prefix from the key's hash: spreads a sequential key over the key range, repeatably."""
    return F.concat(F.lpad(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"), 2, "0"), key)
