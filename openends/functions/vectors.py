"""Vector expressions on array columns. Sums are kept in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from openends.functions import text as tx


def dot(left: Column, right: Column) -> Column:
    """Dot product; NULL if a vector is missing or the lengths differ."""
    return F.aggregate(
        F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, product: total + product,
    )


def norm(vector: Column) -> Column:
    """Euclidean length."""
    squares = F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def _bind(value: Column, body) -> Column:
    """Evaluate `value` once per row and hand it to `body`, like a local variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scale(vector: Column, length: Column) -> Column:
    """Divide every element by `length`."""
    return _bind(length, lambda d: F.transform(vector, lambda x: x.cast("double") / d))


def normalize(vector: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    length = norm(vector)
    return scale(vector, F.when(length == 0, F.lit(1.0)).otherwise(length))


def normalize_floored(vector: Column, floor: float = 1e-8) -> Column:
    """Unit vector with the length floored, as used for centroids."""
    return scale(vector, F.greatest(norm(vector), F.lit(floor)))


def truncate(vector: Column, dim: int) -> Column:
    """First `dim` elements as a unit vector; unchanged if there are no more."""
    return F.when(F.size(vector) <= dim, vector).otherwise(
        normalize(F.slice(vector, 1, dim))
    )


def cosine(left: Column, right: Column, guard: float = 1e-8) -> Column:
    """Cosine with a small guard in the denominator, as the diagnostics use it."""
    return dot(left, right) / (norm(left) * norm(right) + F.lit(guard))


def to_unit_interval(similarity: Column) -> Column:
    """Cosine in [-1, 1] to a score in [0, 1]; NULL stays NULL."""
    return (similarity + 1.0) / 2.0


def hash_bucket(token: Column, dim: int) -> Column:
    """Bucket of a token: leading 32 bits of its MD5, modulo the dimension."""
    lead = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")
    return F.pmod(lead, F.lit(dim)).cast("int")


def hashed_counts(text: Column, dim: int) -> Column:
    """Token counts per hash bucket for the whole text, as one row-local expression.

    The buckets are sorted together with one of each kind, so that all occur; a bucket's
    count is the length of its run, less the one. The work grows with the tokens, not with the tokens
    times the buckets, and needs no shuffle.
    """
    buckets = F.transform(tx.tokens(text), lambda token: hash_bucket(token, dim))
    each = F.sequence(F.lit(0), F.lit(dim - 1))

    def run_ends(found: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(found))
        # Past the last place F.get gives NULL, which no bucket equals.
        return F.filter(
            places, lambda p: ~F.get(found, p - 1).eqNullSafe(F.get(found, p))
        )

    ends = _bind(F.sort_array(F.concat(buckets, each)), run_ends)
    return _bind(
        ends,
        lambda end: F.transform(
            end,
            lambda e, i: (e - F.coalesce(F.get(end, i - 1), F.lit(0)) - 1).cast("double"),
        ),
    )


def hashed_vector(text: Column, dim: int) -> Column:
    """Unit vector of hashed token counts: the built-in encoder."""
    return _bind(hashed_counts(text, dim), normalize)
