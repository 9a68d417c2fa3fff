"""Nested catalogs and matrices."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefer(df: DataFrame, codes: Mapping[str, str], value: str = "preferred_code",
           source: str = "preferred_format", has: str = "is_available") -> DataFrame:
    """First non-empty value among alternatives, the name of its source and a
    has-any flag. ``codes`` maps source name to column, in order of preference."""
    present = {name: F.when(F.length(F.col(c)) > 0, F.col(c)) for name, c in codes.items()}
    first = F.coalesce(*present.values())
    named = F.coalesce(*[F.when(v.isNotNull(), F.lit(n)) for n, v in present.items()])
    return df.withColumns({value: first, source: named, has: first.isNotNull()})


def flatten_catalog(df: DataFrame, years: str = "years") -> DataFrame:
    """Entry → years → periods → modules[] as one row per module. ``years`` is
    ``map<year, map<period, struct<period_value, modules: array<struct>>>>``."""
    entry = [c for c in df.columns if c != years]
    return (df.select(*entry, F.explode(years).alias("year", "_periods"))
            .select(*entry, "year", F.explode("_periods").alias("period_label", "_period"))
            .select(*entry, "year", "period_label", F.col("_period.period_value").alias("period_value"),
                    F.explode("_period.modules").alias("_module"))
            .select(*entry, "year", "period_label", "period_value", "_module.*"))


def prune_catalog(df: DataFrame, entry: Column | None = None, year: Callable[[Column], Column] | None = None,
                  period: Callable[[Column], Column] | None = None,
                  module: Callable[[Column], Column] | None = None, years: str = "years") -> DataFrame:
    """Drop entries, years, periods and modules that do not match, and whatever
    becomes empty by that; everything happens inside the row."""
    keep = year or (lambda y: F.lit(True))
    keep_period = period or (lambda p: F.lit(True))
    keep_module = module or (lambda m: F.lit(True))

    def prune_period(_, p: Column) -> Column:
        return p.withField("modules", F.filter(p["modules"], keep_module))

    def prune_year(_, periods: Column) -> Column:
        named = F.map_filter(periods, lambda label, _p: keep_period(label))
        return F.map_filter(F.transform_values(named, prune_period), lambda _l, p: F.size(p["modules"]) > 0)

    pruned = F.transform_values(F.map_filter(F.col(years), lambda y, _p: keep(y)), prune_year)
    out = (df if entry is None else df.filter(entry)).withColumn(
        years, F.map_filter(pruned, lambda _y, periods: F.size(periods) > 0))
    return out.filter(F.size(years) > 0)


def explode_matrix(df: DataFrame, col: str, element: str = "int") -> DataFrame:
    """JSON matrix text as one row per cell: (…, row, column, value)."""
    rest = [c for c in df.columns if c != col]
    rows = df.select(*rest, F.posexplode(F.from_json(col, f"array<array<{element}>>")).alias("row", "_cells"))
    return rows.select(*rest, "row", F.posexplode("_cells").alias("column", "value"))
