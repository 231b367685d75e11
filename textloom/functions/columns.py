"""Column expressions shared by the operators. All stay on the JVM side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalised(c: Column | str) -> Column:
    """White space collapsed, trimmed, case folded (lower case with sharp s written out)."""
    return F.replace(F.lower(F.trim(F.regexp_replace(col(c), r"\s+", " "))), F.lit("ß"), F.lit("ss"))


def content_digest(c: Column | str) -> Column:
    return F.sha2(normalised(c), 256)


def words(c: Column | str) -> Column:
    """Runs of letters and digits, lower-cased, in order; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def numbers(c: Column | str) -> Column:
    """Runs of digits, sorted, repeats kept."""
    return F.array_sort(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"\d+"), F.lit(0)))


def matching(text: str, *columns: str) -> Column:
    """Case-insensitive substring search over several columns; the text's own wildcards mean themselves."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.lower(F.col(c)), F.lower(F.lit(text))), F.lit(False)) for c in columns])


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity in double precision; null where a vector is null or all zero or the widths differ."""
    size = F.sqrt(dot(a, a) * dot(b, b))
    return F.when((F.size(col(a)) == F.size(col(b))) & (size > 0), dot(a, b) / size)


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two arrays; null where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union)


def share_of(a: Column, b: Column) -> Column:
    """Share of a's distinct elements that b has; null, which abstains, where a is empty."""
    own = F.size(F.array_distinct(a))
    return F.when(own > 0, F.size(F.array_intersect(a, b)) / own)


def share(part: Column, whole: Column, digits: int = 6) -> Column:
    """part over whole as a rounded double, null where the whole is zero."""
    return F.round(part / F.nullif(whole, F.lit(0)), digits)
