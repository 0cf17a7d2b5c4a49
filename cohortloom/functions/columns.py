"""Column expressions. Every function returns a lazy, codegen-able ``Column``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom import rules as fixed

ORDINAL_SPAN = 2**32


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def map_category(value: Column | str, mapping: Mapping[str, Sequence[str]]) -> Column:
    """Canonical category of a free-text value, NULL when no spelling matches."""
    pairs = [F.lit(x) for name, spellings in mapping.items() for s in spellings for x in (s, name)]
    return F.try_element_at(F.create_map(*pairs), F.upper(F.trim(as_column(value))))


def null_outside(value: Column | str, low, high) -> Column:
    value = as_column(value)
    return F.when(value.between(low, high), value)


def at_least(value: Column | str, minimum) -> Column:
    """``value >= minimum``; NULL stays NULL, so a later filter drops it."""
    return as_column(value) >= F.lit(minimum)


def epoch_seconds(moment: Column | str) -> Column:
    """Whole seconds since the epoch, for timestamps with or without a zone."""
    return as_column(moment).cast("timestamp").cast("long")


def elapsed_hours(start: Column | str, end: Column | str, digits: int) -> Column:
    return F.round((epoch_seconds(end) - epoch_seconds(start)) / F.lit(3600.0), digits)


def round_numeric(value: Column, digits: int) -> Column:
    """Half-up rounding of the decimal reading of a double, as a SQL warehouse
    rounds a numeric: 3.4149999999999996 is read as 3.415 and gives 3.42."""
    read = F.round(value.try_cast("decimal(28,12)"), digits).cast("double")
    # A double too large for that has no digits behind the point.
    return F.coalesce(read, F.round(value, digits))


def time_slice(moment: Column | str, seconds: int, shift: int = 0) -> Column:
    """Number of the fixed-width time slice a moment falls in."""
    return F.floor((epoch_seconds(moment) + F.lit(shift)) / F.lit(seconds)).cast("long")


def normalise_code(code: Column | str) -> Column:
    return F.upper(F.replace(F.trim(as_column(code)), F.lit("."), F.lit("")))


def starts_with_any(value: Column | str, prefixes: Iterable[str]) -> Column:
    value = as_column(value)
    return reduce(or_, [value.startswith(p) for p in prefixes], F.lit(False))


def contains_any(value: Column | str, patterns: Iterable[str]) -> Column:
    """Case-blind substring test against any of the patterns."""
    text = F.lower(F.trim(as_column(value)))
    return reduce(or_, [text.contains(p) for p in patterns], F.lit(False))


def normalise_label(label: Column | str, max_length: int = fixed.LABEL_MAX_LENGTH) -> Column:
    """Free-text label to a safe column name, inside the JVM."""
    text = F.lower(F.trim(as_column(label)))
    for symbol, word in fixed.LABEL_WORDS.items():
        text = F.replace(text, F.lit(symbol), F.lit(f" {word} "))
    core = F.btrim(F.regexp_replace(text, "[^0-9a-z]+", "_"), F.lit("_"))
    named = (
        F.when(core == "", F.lit(fixed.LABEL_EMPTY))
        .when(core.rlike("^[0-9]"), F.concat(F.lit(fixed.LABEL_DIGIT_PREFIX), core))
        .otherwise(core)
    )
    return F.rtrim(F.substring(named, 1, max_length), F.lit("_"))


def hash_ordinal(key: Column | str, salt: str, mode: str = "murmur3") -> Column:
    """A number in [0, 2**32) that orders rows as the salted hash does.

    ``murmur3`` follows Spark's own signed ``hash``; ``md5`` uses the first 32
    bits of the digest and can be repeated by any engine.
    """
    salted = F.concat_ws("::", F.lit(salt), as_column(key).cast("string"))
    if mode == "murmur3":
        return F.hash(salted).cast("long") + F.lit(2**31)
    if mode == "md5":
        return F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("long")
    raise ValueError(f"unknown hash mode {mode!r}")


def hash_bucket(key: Column | str, salt: str, buckets: int = 100, mode: str = "murmur3") -> Column:
    """Stable bucket number of a key in [0, buckets)."""
    if mode == "murmur3":
        salted = F.concat_ws("::", F.lit(salt), as_column(key).cast("string"))
        return F.pmod(F.hash(salted), F.lit(buckets))
    return (hash_ordinal(key, salt, mode) % F.lit(buckets)).cast("int")


def banded(value: Column | str, bands, rest: str, inclusive: bool) -> Column:
    """Name of the first band whose upper bound holds the value."""
    value = as_column(value)
    # Built from the last band outwards so that the first match wins; a NULL
    # value fails every test and lands in ``rest``, as a SQL CASE does.
    out = F.lit(rest)
    for name, bound in reversed(tuple(bands)):
        out = F.when(value <= bound if inclusive else value < bound, F.lit(name)).otherwise(out)
    return out


def conditional_count(condition: Column) -> Column:
    return F.count_if(condition)


def conditional_max(value: Column | str, condition: Column) -> Column:
    return F.max(F.when(condition, as_column(value)))


def sample_sd(value: Column | str) -> Column:
    return F.stddev_samp(as_column(value))


def bounded_median(value: Column | str) -> Column:
    """Exact interpolated median for values with few distinct levels (ages, run
    counts). The aggregate keeps one counter per distinct value; for measured
    quantities use ``ranking.exact_quantile`` instead."""
    return F.percentile(as_column(value), F.lit(0.5))


def surrogate_key(*columns: str) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(fixed.SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))

