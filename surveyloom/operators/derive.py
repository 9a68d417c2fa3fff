"""Derived columns described as data: a list of (name, inputs, rule) entries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flag, row_sum


@dataclass(frozen=True)
class Indicator:
    """One derived column. It is skipped when an input column is missing, unless
    ``partial`` is set; then the rule gets the inputs that exist."""

    name: str
    inputs: tuple[str, ...]
    rule: Callable[..., Column]
    partial: bool = False
    description: str = ""


def derive_indicators(df: DataFrame, spec: Sequence[Indicator]) -> DataFrame:
    """Apply a specification. An entry may use columns derived before it; runs
    of independent entries become one projection."""
    pending: dict[str, Column] = {}
    for item in spec:
        if pending and (item.name in pending or set(item.inputs) & set(pending)):
            df, pending = df.withColumns(pending), {}
        present = [c for c in item.inputs if c in df.columns]
        if len(present) < len(item.inputs) and not (item.partial and present):
            continue
        args = [F.col(c) for c in present]
        pending[item.name] = item.rule(args) if item.partial else item.rule(*args)
    return df.withColumns(pending) if pending else df


engineer = derive_indicators


def programme_totals(df: DataFrame, groups: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """For every group: the amount received over its columns, and whether any was
    received. ``groups`` maps amount name to (flag name, columns)."""
    amounts = {name: row_sum([c for c in cols if c in df.columns]) for name, (_, cols) in groups.items()}
    out = df.withColumns(amounts)
    return out.withColumns({flag_name: flag(F.col(name) > 0) for name, (flag_name, _) in groups.items()})
