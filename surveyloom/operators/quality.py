"""Checks, rules and dictionaries. Rule tables hold one row per column or per
rule, so everything but the counting passes over the data is small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import composite_id, label_rules, normalize_text
from .common import explode_stats, long_text, present_only
from .profile import column_shapes, null_percent, profile_columns
from .projection import rename_map, select_existing


# ---------------------------------------------------------------- keys

def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, key: Sequence[str], name: str = "table") -> DataFrame:
    """Fail when a key repeats; otherwise return the table."""
    bad = key_violations(df, key).limit(1).collect()
    if bad:
        raise ValueError(f"{name} is not unique by {', '.join(key)}: {bad[0].asDict()}")
    return df


def ensure_unique(df: DataFrame, key: Sequence[str], name: str = "table") -> DataFrame:
    """The table with a check inside its plan: running it fails when a key
    repeats. The check needs the partitioning a join on the key needs anyway, so
    the table is not computed twice."""
    size, own = F.count(F.lit(1)).over(Window.partitionBy(*key)), "_size"
    while own in df.columns:   # a column of the caller stays as it is
        own = f"_{own}"
    message = F.lit(f"{name} is not unique by {', '.join(key)}")
    fine = F.when(F.col(own) == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.withColumn(own, size).filter(fine).drop(own)


def key_audit(df: DataFrame, candidates: Sequence[Sequence[str]], table: str = "") -> DataFrame:
    """For every candidate key whose columns exist: surplus rows and uniqueness."""
    def one(key: Sequence[str]) -> DataFrame:
        sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count")).select(
            F.lit(table).alias("table_name"), F.lit("|".join(key)).alias("candidate_key"), "duplicate_count",
            (F.col("duplicate_count") == 0).alias("is_unique"))

    present = [k for k in candidates if set(k) <= set(df.columns)]
    return reduce(DataFrame.unionByName, [one(k) for k in present])


def duplicate_groups(df: DataFrame, key: Sequence[str], n: int = 20) -> DataFrame:
    """Largest groups sharing a key."""
    return key_violations(df, key).withColumnRenamed("n", "duplicate_rows").orderBy(
        F.desc("duplicate_rows"), *key).limit(n)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


# ---------------------------------------------------------------- value rules

def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each cross-column rule; an undecided rule is not broken."""
    wide = df.agg(*[F.count_if(c).alias(f"v_{i}") for i, c in enumerate(rules.values())])
    return explode_stats(wide, [{"rule": F.lit(n), "violations": F.col(f"v_{i}")} for i, n in enumerate(rules)])


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every present value of every column, one row each."""
    return long_text(present_only(df, cols), cols).filter(F.col("value").isNotNull()).distinct()


def binary_validation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every value of every column, one row each, with the number of values of its
    column and whether these are only 0 and 1 (compared as numbers, so 1.00 is 1).
    A column without a present value has no row."""
    values = distinct_values(df, cols)
    number = F.expr("try_cast(value AS double)")
    binary = F.coalesce(number.isin(0.0, 1.0), F.lit(False)) | F.col("value").isin("true", "false")
    counts = values.groupBy("variable").agg(F.count(F.lit(1)).alias("n_values"), F.every(binary).alias("is_binary_01"))
    return values.join(F.broadcast(counts), "variable").select(  # one row per column of the table
        "variable", "value", "n_values", "is_binary_01")


def constant_columns(df: DataFrame) -> list[tuple[str, str]]:
    """(column, ``all_null`` or ``constant``) for columns with one value, where
    missing counts as a value."""
    found = column_shapes(df).filter("is_constant").select(
        "variable", F.when(F.col("present") == 0, "all_null").otherwise("constant").alias("reason"))
    return [tuple(r) for r in found.collect()]  # at most one row per column


def drop_constant(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop all-null and constant columns and list them."""
    found = constant_columns(df)
    report = df.sparkSession.createDataFrame(found, "variable string, reason string")
    return df.drop(*[c for c, _ in found]), report


@dataclass(frozen=True)
class DropRules:
    """Columns to leave out of a model table, by kind of reason."""

    leakage: Mapping[str, str] = field(default_factory=dict)
    redundant: Mapping[str, str] = field(default_factory=dict)
    identifiers: Sequence[str] = ()
    auxiliary: Sequence[str] = ()


def apply_drop_rules(df: DataFrame, rules: DropRules,
                     constants: Sequence[tuple[str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Model-ready view and the reason of every dropped column. Constant columns
    are looked for unless they are given."""
    rows = [(c, "leakage", why) for c, why in rules.leakage.items()]
    rows += [(c, "redundant", why) for c, why in rules.redundant.items()]
    rows += [(c, "identifier", "identifier without use in a model") for c in rules.identifiers]
    rows += [(c, "auxiliary", "auxiliary or control column") for c in rules.auxiliary]
    rows += [(c, "constant", why) for c, why in (constant_columns(df) if constants is None else constants)]
    rows = list(dict.fromkeys(r for r in rows if r[0] in df.columns))
    reasons = df.sparkSession.createDataFrame(rows, "variable string, kind string, reason string")
    return df.drop(*{r[0] for r in rows}), reasons


def recommend_features(profile: DataFrame, leak_patterns: Sequence[str], target: str,
                       max_null_pct: float = 30.0) -> DataFrame:
    """Decision per profiled column: target, leakage by name, too many missing,
    constant, or include."""
    leak = reduce(lambda a, b: a | b, [F.lower("variable").contains(p) for p in leak_patterns], F.lit(False))
    rules = [(F.col("variable") == target, ("target", "target variable")),
             (leak, ("exclude_conservative", "name suggests leakage")),
             (F.col("null_pct") > max_null_pct, ("review", "high share of missing values")),
             (F.col("n_unique") <= 1, ("exclude", "constant column"))]
    default = ("include_conservative", "usable in exploration and first models")
    return profile.select("variable", label_rules([(c, d) for c, (d, _) in rules], default[0]).alias("decision"),
                          label_rules([(c, r) for c, (_, r) in rules], default[1]).alias("reason"))


def classify_features(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Binary, numeric or categorical; needs imputation; needs encoding."""
    numeric = "^(tinyint|smallint|int|bigint|float|double|decimal)"
    kind = label_rules([(F.col("is_binary") | (F.col("present") == 0), "binary"),
                        (F.col("dtype").rlike(numeric), "numeric")], "categorical")
    pct = F.round(F.try_divide((F.col("total") - F.col("present")) * 100.0, F.col("total")), 4)
    shapes = column_shapes(df, [c for c in df.columns if c not in skip])
    return shapes.select("variable", kind.alias("feature_type"), "dtype", F.coalesce(pct, F.lit(0.0)).alias("null_pct")
                         ).withColumns({"needs_imputation": F.col("null_pct") > 0,
                                        "needs_encoding": F.col("feature_type") == "categorical"})


def classify_tables(schema: DataFrame, rules: Sequence[tuple[Sequence[str], str, str]],
                    default: tuple[str, str]) -> DataFrame:
    """Grain and merge strategy of every table in a (table_name, column_name)
    frame; the first rule whose columns are all present wins."""
    have = schema.groupBy("table_name").agg(*[
        (F.count_distinct(F.when(F.col("column_name").isin(list(need)), F.col("column_name"))) == len(set(need)))
        .alias(f"r_{i}") for i, (need, _, _) in enumerate(rules)], F.count(F.lit(1)).alias("columns"))
    return have.select(
        "table_name", "columns",
        label_rules([(F.col(f"r_{i}"), g) for i, (_, g, _) in enumerate(rules)], default[0]).alias("grain"),
        label_rules([(F.col(f"r_{i}"), m) for i, (_, _, m) in enumerate(rules)], default[1]).alias("merge_strategy"))


@dataclass(frozen=True)
class DimensionRule:
    """Names and prefixes that belong to one dimension. ``eligible`` is a fixed
    answer, or the names it is true for, or (negated) the names it is false for."""

    dimension: str
    subdimension: str
    names: Sequence[str] = ()
    prefixes: Sequence[str] = ()
    eligible: bool = True
    eligible_only: Sequence[str] = ()
    eligible_except: Sequence[str] = ()
    family: str = "none"
    reason: str = ""


def classify_variables(df: DataFrame, rules: Sequence[DimensionRule], default: DimensionRule,
                       variable: str = "variable") -> DataFrame:
    """Dimension, sub-dimension, family, eligibility and reason per variable;
    the first matching rule wins."""
    v = F.col(variable)

    def match(r: DimensionRule) -> Column:
        tests = ([v.isin(list(r.names))] if r.names else []) + [v.startswith(p) for p in r.prefixes]
        return reduce(lambda a, b: a | b, tests)

    def result(r: DimensionRule) -> Column:
        fits = (v.isin(list(r.eligible_only)) if r.eligible_only
                else ~v.isin(list(r.eligible_except)) if r.eligible_except else F.lit(r.eligible))
        return F.struct(F.lit(r.dimension).alias("dimension"), F.lit(r.subdimension).alias("subdimension"),
                        F.lit(r.family).alias("family"), fits.alias("eligible"), F.lit(r.reason).alias("reason"))

    picked = label_rules([(match(r), result(r)) for r in rules], result(default))
    return df.withColumn("_rule", picked).select(*df.columns, "_rule.*")


def dimension_summary(mapped: DataFrame) -> DataFrame:
    """Variables per dimension, family and eligibility."""
    return mapped.groupBy("dimension", "family", "eligible").agg(F.count(F.lit(1)).alias("n_variables"))


def build_dictionary(df: DataFrame, sources: Mapping[str, tuple[Sequence[tuple], Column]],
                     roles: Mapping[str, str], default_role: str = "feature",
                     notes: Mapping[str, str] | None = None, profile: DataFrame | None = None) -> DataFrame:
    """One row per column: type, missing percent, looked-up attributes, role and
    note. ``sources`` maps attribute to (priority lookups, default)."""
    from .joins import lookup_first

    out = profile if profile is not None else profile_columns(df).select("variable", "dtype", "null_pct")
    for name, (tables, default) in sources.items():
        out = lookup_first(out, tables, name, default)
    role = label_rules([(F.col("variable") == c, r) for c, r in roles.items()], default_role)
    note = label_rules([(F.col("variable") == c, n) for c, n in (notes or {}).items()], "")
    return out.withColumns({"role": role, "note": note})


def redundancy_matrix(rules: DataFrame, scores: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Redundancy rules (drop, keep, kind, reason) with the score of both sides. A variable
    listed twice counts with its highest score; rules are never multiplied."""
    from .ordered import first_per_group

    out = rules
    scores = first_per_group(scores.select("variable", "f_score", "p_value"), ["variable"], [-F.col("f_score"), "p_value"])
    if dictionary is not None:
        dictionary = dictionary.groupBy("variable").agg(F.min("description").alias("description"), F.min("dimension").alias("dimension"))
    for side in ("drop", "keep"):
        attached = scores.select(F.col("variable").alias(side), F.col("f_score").alias(f"f_score_{side}"),
                                 F.col("p_value").alias(f"p_value_{side}"))
        out = out.join(attached, side, "left")
        if dictionary is not None:
            text = dictionary.select(F.col("variable").alias(side), F.col("description").alias(f"description_{side}"),
                                     F.col("dimension").alias(f"_dim_{side}"))
            out = out.join(text, side, "left").withColumn(
                f"description_{side}", F.coalesce(f"description_{side}", F.lit("")))
    if dictionary is not None:
        out = out.withColumn("dimension", F.coalesce("_dim_drop", "_dim_keep", F.lit(""))).drop(
            "_dim_drop", "_dim_keep")
    return out


def drop_redundant(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The table without the columns a redundancy rule drops."""
    return df.drop(*[c for c in names if c in df.columns])


def applicable_rules(df: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """The (drop, keep, kind) rules whose dropped column the table has."""
    return df.sparkSession.createDataFrame([r for r in rules if r[0] in df.columns],
                                           "drop string, keep string, kind string")


def concept_search(variables: DataFrame, text: str, queries: Mapping[str, Sequence[str]],
                   allowed: Column) -> DataFrame:
    """For each concept and query: hits, hits that pass the filters, and status;
    one extra row for a concept without any usable hit.

    The queries are constants of the plan: each row lists the queries it
    contains, so rows are never multiplied by queries that do not match.
    """
    spark = variables.sparkSession
    pairs = [(c, q) for c, qs in queries.items() for q in qs]
    listed = F.array(*[F.struct(F.lit(c).alias("concept"), F.lit(q).alias("query")) for c, q in pairs])
    hay = normalize_text(text)
    matched = F.filter(listed, lambda p: hay.contains(F.lower(F.trim(p["query"]))))
    hits = (variables.select(F.explode(matched).alias("_p"), F.coalesce(allowed, F.lit(False)).alias("_ok"))
            .groupBy("_p.concept", "_p.query").agg(F.count(F.lit(1)).alias("raw"), F.count_if("_ok").alias("kept")))
    asked = spark.createDataFrame(pairs, "concept string, query string")
    per_query = asked.join(hits, ["concept", "query"], "left").select(
        "concept", "query", F.coalesce("raw", F.lit(0)).alias("result_count_raw"),
        F.coalesce("kept", F.lit(0)).alias("result_count_filtered")).withColumn(
        "status", label_rules([(F.col("result_count_filtered") > 0, "ok"),
                               (F.col("result_count_raw") > 0, "outside_universe")], "no_results"))
    joined = F.create_map(*[F.lit(x) for c, qs in queries.items() for x in (c, "|".join(qs))])
    nothing = per_query.groupBy("concept").agg(F.sum("result_count_filtered").alias("s")).filter("s = 0").select(
        "concept", F.element_at(joined, F.col("concept")).alias("query"), F.lit(0).cast("bigint").alias("result_count_raw"),
        F.lit(0).cast("bigint").alias("result_count_filtered"), F.lit("no_direct_equivalent").alias("status"))
    return per_query.unionByName(nothing)


def validate(df: DataFrame, step: str, counts: Mapping[str, Column], passed: Column) -> DataFrame:
    """One validation record: the counts, and whether the step passed. ``passed``
    is written over the count names."""
    return df.agg(*[c.alias(n) for n, c in counts.items()]).select(
        F.lit(step).alias("step"), passed.alias("passed"), *counts)


def model_ready(df: DataFrame, key: Sequence[str], id_parts: Sequence[str], id_name: str, leading: Sequence[str],
                features: Sequence[str], renames: Mapping[str, str], check: bool = True) -> tuple[DataFrame, DataFrame]:
    """Final table: composite id, leading columns, features; renamed, ordered and
    unique by key and by id. Also the old → new report."""
    kept = select_existing(df, [*id_parts, *key, *leading, *features])
    if check:
        kept = ensure_unique(kept, key, "source table")
    types = {f.name: f.dataType for f in kept.schema.fields}
    named = kept.select(composite_id(id_parts, [types[c] for c in id_parts]).alias(id_name), *kept.columns)
    if check:
        named = ensure_unique(named, [id_name], id_name)
    renamed, report = rename_map(named, renames)
    order = [id_name, *[renames.get(c, c) for c in [*key, *id_parts, *leading, *features]]]
    return select_existing(renamed, order), report


def variable_dictionary(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Specification rows (variable, …) with the missing percent of the column."""
    nulls = null_percent(df)
    return spec.join(nulls, "variable", "inner")


def variable_map(columns: DataFrame, roles: Sequence[tuple[Sequence[str], str, str, bool]],
                 renames: Mapping[str, str], features: DataFrame) -> DataFrame:
    """Role, group and training flag of every kept column, then the selected
    features; rows equal in (original, final, role) count once, the first kept."""
    v = F.col("variable_original")

    def pick(i: int, default):
        return label_rules([(v.isin(list(r[0])), r[i]) for r in roles], default)

    final = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in renames.items() for x in kv]), v), v) \
        if renames else v
    base = columns.select(F.col("variable").alias("variable_original")).select(
        v, final.alias("variable_final"), pick(1, "feature").alias("role"), pick(2, "metadata").alias("group"),
        pick(3, True).alias("in_training"), F.lit("").alias("description"), F.lit(0).alias("_o"))
    chosen = features.select(F.col("variable").alias("variable_original"), "group", "description").select(
        v, final.alias("variable_final"), F.lit("feature").alias("role"), "group", F.lit(True).alias("in_training"),
        "description", F.lit(1).alias("_o"))
    from .ordered import first_per_group

    rows = base.unionByName(chosen)
    return first_per_group(rows, ["variable_original", "variable_final", "role"], ["_o", "group"]).drop("_o").orderBy(
        "role", "group", "variable_final")
