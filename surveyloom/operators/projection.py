"""Projections decided from the column names and types of the plan."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions import as_number


def standard_name(name: str) -> str:
    """Lower-case ASCII name with single underscores."""
    plain = unicodedata.normalize("NFKD", str(name).strip().lower())
    plain = "".join(ch for ch in plain if not unicodedata.combining(ch))
    return re.sub(r"[^0-9a-z]+", "_", plain).strip("_")


def _fail_on_repeats(names: Iterable[str], what: str) -> None:
    repeated = sorted(n for n, k in Counter(names).items() if k > 1)
    if repeated:
        raise ValueError(f"{what}: {', '.join(repeated)}")


def standardize_columns(df: DataFrame, table: str = "") -> tuple[DataFrame, DataFrame]:
    """Rename every column to its standard name and return the mapping too."""
    names = [standard_name(c) for c in df.columns]
    _fail_on_repeats(names, "columns collide after standardising")
    mapping = df.sparkSession.createDataFrame(
        [(table, old, new) for old, new in zip(df.columns, names)],
        "table_name string, original_column string, standardized_column string")
    return df.toDF(*names), mapping


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order, each once."""
    return df.select(*[n for n in dict.fromkeys(names) if n in df.columns])


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric reading of the listed columns that exist."""
    return df.withColumns({c: as_number(c) for c in cols if c in df.columns})


def fill_int(df: DataFrame, cols: Sequence[str], value: int = 0) -> DataFrame:
    """Missing becomes ``value``, then the column is cast to integer."""
    return df.withColumns({c: F.coalesce(as_number(c), F.lit(float(value))).cast("int")
                           for c in cols if c in df.columns})


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rename by map and report old and new names; two equal new names fail."""
    used = {old: new for old, new in mapping.items() if old in df.columns}
    _fail_on_repeats([used.get(c, c) for c in df.columns], "renamed columns collide")
    report = df.sparkSession.createDataFrame(
        [(c, used.get(c, c), c in used) for c in df.columns],
        "original_column string, renamed_column string, was_renamed boolean")
    return df.withColumnsRenamed(used), report


def _sorted_nested(c: Column, kind: DataType) -> Column:
    """The same nested value with struct fields and map keys in sorted order."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        built = F.struct(*[_sorted_nested(c[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(c.isNotNull(), built)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: _sorted_nested(x, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.array_sort(F.transform(F.map_keys(c), lambda k: k))
        return F.map_from_arrays(entries, F.transform(
            entries, lambda k: _sorted_nested(F.element_at(c, k), kind.valueType)))
    return c


def nested_to_json(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps become JSON text with sorted keys."""
    nested = {f.name: F.to_json(_sorted_nested(F.col(f.name), f.dataType)) for f in df.schema.fields
              if isinstance(f.dataType, (StructType, ArrayType, MapType))}
    return df.withColumns(nested) if nested else df


def storage_safe(df: DataFrame) -> DataFrame:
    """A table every file format can hold: nested values as JSON, untyped nulls
    and intervals as text."""
    plain = nested_to_json(df)
    odd = [n for n, t in plain.dtypes if t == "void" or t.startswith(("interval", "variant"))]
    return plain.withColumns({n: F.col(n).cast("string") for n in odd}) if odd else plain
