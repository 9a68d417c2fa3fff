"""Roll-ups from a child table to its parent key. Every measure of a roll-up is
taken in one aggregate, so the child table is shuffled once, after combining."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_number, count_positive, flag, zfill
from .joins import mark_exists
from .ordered import _ordered_key, first_per_group

UNIT_ROWS = 250_000   # rows that one task sorts and counts for a join by person


def _by_unit(df: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Rows dealt by unit to partitions of about ``UNIT_ROWS``. Keys compress well, so
    partitions of equal bytes would hold many million rows, all sorted and hashed at once."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // UNIT_ROWS))
    return df.repartition(parts, *unit)


def count_if_by(df: DataFrame, keys: Sequence[str], conds: Mapping[str, Column]) -> DataFrame:
    """Conditional counts per group; an undecided condition does not count."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conds.items()])


def flag_agg_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], maxima: Mapping[str, str],
                any_of: Mapping[str, str] | None = None) -> DataFrame:
    """Sum and maximum of 0/1 columns per group, and any-flags over the sums;
    the mappings give output name → input column (for ``any_of``: → sum name)."""
    out = df.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()],
                                *[F.max(c).alias(n) for n, c in maxima.items()])
    return out.withColumns({n: flag(F.col(s) > 0) for n, s in (any_of or {}).items()})


def head_audit(df: DataFrame, keys: Sequence[str], is_head: Column) -> DataFrame:
    """Groups whose number of heads is not one."""
    heads = df.groupBy(*keys).agg(F.count_if(is_head).alias("n_heads"))
    return heads.filter(F.col("n_heads") != 1)


def find_heads(df: DataFrame, keys: Sequence[str], person: str, is_head: Column,
               order: Sequence[str] = ()) -> DataFrame:
    """Key of the first head of every group."""
    heads = df.filter(F.coalesce(is_head, F.lit(False)))
    return first_per_group(heads, keys, [person, *order], keep=[person])


def rollup_roster(df: DataFrame, keys: Sequence[str], person: str, age: str, is_head: Column,
                  bands: Mapping[str, tuple[float, float]], attributes: Mapping[str, str],
                  order: Sequence[str] = ()) -> DataFrame:
    """Members, members per age band, the first head's attributes and the number
    of heads. ``attributes`` maps output name to column."""
    years = as_number(age)
    head = F.coalesce(is_head, F.lit(False))
    packed = F.struct(*[k.alias(f"_o{i}") for i, k in enumerate(_ordered_key([person, *order]))],
                      *[F.col(c).alias(n) for n, c in attributes.items()])
    out = df.groupBy(*keys).agg(
        F.count_distinct(person).alias("n_members"),
        *[F.count_if(years.between(lo, hi)).alias(n) for n, (lo, hi) in bands.items()],
        F.min(F.when(head, packed)).alias("_head"), F.count_if(head).alias("n_heads"))
    return out.select(*keys, "n_members", *bands, "n_heads", *[F.col(f"_head.{n}").alias(n) for n in attributes])


def rollup_education(df: DataFrame, roster: DataFrame, heads: DataFrame, keys: Sequence[str], person: str,
                     age: str, school_age: tuple[float, float], enrolled: Column, not_enrolled: Column,
                     not_attending: Column, attributes: Mapping[str, str], order: Sequence[str] = ()) -> DataFrame:
    """Persons, school-age persons by enrolment and attendance, and the head's
    education. The roster brings the age, ``heads`` the head of each group."""
    unit = [*keys, person]
    ages = roster.select(*unit, as_number(age).alias("_age"))
    joined = mark_exists(_by_unit(df, unit).join(ages, unit, "left"), heads, unit, "_is_head")
    in_school = F.col("_age").between(*school_age)
    packed = F.struct(*[k.alias(f"_o{i}") for i, k in enumerate(_ordered_key([person, *order]))],
                      *[F.col(c).alias(n) for n, c in attributes.items()])
    out = joined.groupBy(*keys).agg(
        F.count_distinct(person).alias("n_persons"), F.count_if(in_school).alias("n_school_age"),
        F.count_if(in_school & enrolled).alias("n_enrolled"),
        F.count_if(in_school & not_enrolled).alias("n_not_enrolled"),
        F.count_if(in_school & not_attending).alias("n_not_attending"),
        F.min(F.when(F.col("_is_head") == 1, packed)).alias("_head"))
    return out.select(*keys, "n_persons", "n_school_age", "n_enrolled", "n_not_enrolled", "n_not_attending",
                      flag(F.col("n_not_enrolled") > 0).alias("any_not_enrolled"),
                      flag(F.col("n_not_attending") > 0).alias("any_not_attending"),
                      *[F.col(f"_head.{n}").alias(n) for n in attributes])


def rollup_health(df: DataFrame, keys: Sequence[str], person: str, flags: Mapping[str, Column],
                  any_of: Mapping[str, str]) -> DataFrame:
    """Persons, persons per health flag, and any-flags."""
    out = df.groupBy(*keys).agg(F.count_distinct(person).alias("n_persons"),
                                *[F.sum(f).cast("bigint").alias(n) for n, f in flags.items()])
    return out.withColumns({n: flag(F.col(s) > 0) for n, s in any_of.items()})


def rollup_employment(df: DataFrame, heads: DataFrame, keys: Sequence[str], person: str,
                      incomes: Sequence[str]) -> DataFrame:
    """Persons, persons with any positive income, and whether the head has one."""
    earns = flag(count_positive([c for c in incomes if c in df.columns]) > 0)
    unit = [*keys, person]
    joined = mark_exists(_by_unit(df.select(*unit, earns.alias("_earns")), unit), heads, unit, "_is_head")
    out = joined.groupBy(*keys).agg(
        F.count_distinct(person).alias("n_persons"), F.sum("_earns").cast("bigint").alias("n_earners"),
        F.max(flag((F.col("_is_head") == 1) & (F.col("_earns") == 1))).alias("head_earns"))
    return out.withColumn("any_earner", flag(F.col("n_earners") > 0))


def join_counts(df: DataFrame, unit: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows and distinct units per group. Both come from one aggregate; a
    missing part of the unit still counts as a unit."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.count_distinct(F.struct(*unit)).alias("n_units"))


def geo_summary(df: DataFrame, code: str, unit: Sequence[str], widths: Mapping[str, int], width: int) -> DataFrame:
    """Rows and unique households per region level."""
    levels = df.withColumns({n: F.substring(zfill(code, width), 1, w) for n, w in widths.items()})
    return join_counts(levels, unit, list(widths))
