"""From raw survey tables to the household model table.

Each step is a lazy plan over the one before. Persons are aggregated to
households before any join, so every join is one-to-one on one key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    any_reported,
    as_number,
    code_levels,
    flag,
    flag_all,
    flag_contains,
    flag_eq,
    flag_in,
    flag_reported,
    if_else,
    map_values,
    norm_cat,
    ratio,
    row_sum,
    zfill,
)
from ..operators.derive import Indicator, derive_indicators, programme_totals
from ..operators.filters import drop_null_target, filter_all
from ..operators.joins import merge_all
from ..operators.profile import profile_columns
from ..operators.projection import select_existing, standardize_columns, to_numeric
from ..operators.quality import (
    applicable_rules,
    apply_drop_rules,
    constant_columns,
    drop_redundant,
    ensure_unique,
    key_audit,
    model_ready,
    rule_violations,
)
from ..operators.rollup import (
    find_heads,
    head_audit,
    rollup_education,
    rollup_employment,
    rollup_health,
    rollup_roster,
)
from ..sources import schema_summary
from . import survey_spec as spec


def profile_tables(tables: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Standard names for every table, and the reports: column mapping, column
    profiles, key audit and table summary."""
    done = {name: standardize_columns(df, name) for name, df in tables.items()}
    clean = {name: df for name, (df, _) in done.items()}
    profiles = [profile_columns(df).withColumn("table_name", F.lit(n)) for n, df in clean.items()]
    keyed = [key_audit(df, spec.CANDIDATE_KEYS, n) for n, df in clean.items()
             if any(set(k) <= set(df.columns) for k in spec.CANDIDATE_KEYS)]
    reports = {
        "column_mapping": reduce(DataFrame.unionByName, [m for _, m in done.values()]),
        "profile": reduce(DataFrame.unionByName, profiles),
        "schema_summary": schema_summary(clean, spec.GRAIN_RULES, spec.GRAIN_DEFAULT),
    }
    if keyed:
        reports["key_audit"] = reduce(DataFrame.unionByName, keyed)
    return clean, reports


def select_region(tables: Mapping[str, DataFrame], prefix: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Rows of one region in every table that has the code, with the audit."""
    return filter_all(tables, spec.REGION_CODE, prefix, spec.CODE_WIDTH)


def _is_head(relation: Column) -> Column:
    return (as_number(relation) == 1) | norm_cat(relation).contains("jefe")


def _equals(col: str, code: int) -> Column:
    return as_number(col) == code


def build_household(dwelling: DataFrame, roster: DataFrame, education: DataFrame, health: DataFrame,
                    employment: DataFrame, summary: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One row per household of the summary table with everything the other
    modules say about it, and the audits."""
    key, person = spec.HOUSEHOLD_KEY, spec.PERSON
    context = select_existing(dwelling, [*key, *spec.DWELLING_KEEP]).distinct()
    summary, context = ensure_unique(summary, key, "summary"), ensure_unique(context, key, "dwelling")

    head = _is_head(F.col("p203"))
    heads = find_heads(roster, key, person, head)
    members = rollup_roster(
        roster, key, person, "p208a", head, spec.AGE_BANDS,
        {"sexo_jefe": "p207", "edad_jefe": "p208a", "codigo_parentesco_jefe": "p203"}).withColumnsRenamed(
        {"n_members": "tam_hogar_mod2", "n_heads": "num_jefes_detectados"}).withColumn("jefe_hogar", F.lit(1))
    school = rollup_education(
        education, roster.select(*key, person, "p208a"), heads, key, person, "p208a", spec.SCHOOL_AGE,
        _equals("p306", 1), _equals("p306", 2), _equals("p307", 2),
        {"educ_jefe_nivel": "p301a", "educ_jefe_anio": "p301b", "educ_jefe_grado": "p301c"}).withColumnsRenamed({
            "n_persons": "personas_con_mod_educ", "n_school_age": "n_6_16_total", "n_enrolled": "n_6_16_matriculados",
            "n_not_enrolled": "n_6_16_no_matriculados", "n_not_attending": "n_6_16_no_asisten",
            "any_not_enrolled": "any_6_16_no_matriculados", "any_not_attending": "any_6_16_no_asisten"})
    reasons = [c for c in spec.NO_CARE_REASONS if c in health.columns]
    care = rollup_health(health, key, person, {
        "miembros_con_sintoma_4w": flag_reported("p4021"), "miembros_con_enfermedad_4w": flag_reported("p4022"),
        "miembros_sin_atencion_salud": any_reported(reasons),
        "miembros_afiliados_essalud": flag_eq(norm_cat("p4191"), "essalud")},
        {"any_sintoma_4w": "miembros_con_sintoma_4w", "any_enfermedad_4w": "miembros_con_enfermedad_4w",
         "any_sin_atencion_salud": "miembros_sin_atencion_salud"}).withColumnRenamed("n_persons", "personas_con_mod_salud")
    work = rollup_employment(employment, heads, key, person, spec.INCOME_COLUMNS).withColumnsRenamed({
        "n_persons": "personas_con_mod_empleo", "n_earners": "miembros_con_ingreso_laboral",
        "head_earns": "jefe_con_ingreso_laboral", "any_earner": "any_ingreso_laboral_hogar"})

    # the roll-ups are unique by construction; only the two inputs are checked
    merged, audit = merge_all(summary, {
        "modulo01_context": context, "modulo02_roster": members, "modulo03_education": school,
        "modulo04_health": care, "modulo05_employment": work}, key, check=False)
    return merged, {
        "merge_audit": audit, "chief_audit": head_audit(roster, key, head),
        "chief_education_missing": school.filter(F.col("educ_jefe_nivel").isNull()).select(*key)}


def _normal(name: str, source: str) -> Indicator:
    return Indicator(name, (source,), norm_cat)


HOUSEHOLD_INDICATORS: Sequence[Indicator] = (
    Indicator("ubigeo", ("ubigeo",), lambda c: zfill(c, spec.CODE_WIDTH)),
    Indicator("departamento_cod", ("ubigeo",), lambda c: code_levels(c, [2])[0]),
    Indicator("provincia_cod", ("ubigeo",), lambda c: code_levels(c, [4])[0]),
    Indicator("distrito_cod", ("ubigeo",), lambda c: code_levels(c, [6])[0]),
    Indicator("sexo_jefe_bin", ("sexo_jefe",), lambda c: map_values(norm_cat(c), spec.SEX_CODES)),
    Indicator("educ_jefe_ord", ("educ_jefe_nivel",), as_number),
    Indicator("educ_jefe", ("educ_jefe_ord",), lambda c: map_values(c, spec.EDUCATION_LEVELS)),
    Indicator("tam_hogar", ("mieperho",), as_number),
    Indicator("num_perceptores", ("percepho",), as_number),
    Indicator("ingreso_hogar", ("inghog1d",), as_number),
    Indicator("gasto_hogar", ("gashog2d",), as_number),
    Indicator("ingreso_percapita", ("ingreso_hogar", "tam_hogar"), ratio),
    _normal("material_piso", "p103"),
    Indicator("piso_precario", ("material_piso",), lambda c: flag_in(c, spec.POOR_FLOOR)),
    _normal("fuente_agua", "p110"),
    Indicator("acceso_agua_red", ("fuente_agua",), lambda c: flag_contains(c, "red publica")),
    Indicator("agua_potable_reportada", ("p110a1",), lambda c: flag_eq(norm_cat(c), "si")),
    Indicator("agua_disponible_diaria", ("p110c",), lambda c: flag_eq(norm_cat(c), "si")),
    Indicator("agua_segura_proxy", ("acceso_agua_red", "agua_potable_reportada"), lambda a, b: flag_all([a, b])),
    _normal("tipo_desague", "p111a"),
    Indicator("acceso_desague_red", ("tipo_desague",), lambda c: flag_contains(c, "red publica")),
    Indicator("saneamiento_inadecuado", ("tipo_desague",), lambda c: flag_in(c, spec.BAD_SANITATION)),
    Indicator("acceso_electricidad", ("p1121",), lambda c: flag_eq(norm_cat(c), "electricidad")),
    _normal("combustible_principal", "p113a"),
    Indicator("combustible_limpio", ("combustible_principal",), lambda c: flag_in(c, spec.CLEAN_FUEL)),
    Indicator("combustible_precario", ("combustible_principal",), lambda c: flag_in(c, spec.POOR_FUEL)),
    Indicator("internet_hogar", ("p1144",), lambda c: flag_eq(norm_cat(c), "conexion a internet")),
    Indicator("area_urbana_rural", ("estrato",), lambda c: if_else(norm_cat(c).contains("rural"), "rural", "urbana")),
    Indicator("area_rural_bin", ("area_urbana_rural",), lambda c: flag_eq(c, "rural")),
    Indicator("health_no_attention", ("any_sin_atencion_salud",), lambda c: F.coalesce(c, F.lit(0)).cast("int")),
    Indicator("children_not_enrolled", ("any_6_16_no_matriculados",), lambda c: F.coalesce(c, F.lit(0)).cast("int")),
    Indicator("children_not_attending", ("any_6_16_no_asisten",), lambda c: F.coalesce(c, F.lit(0)).cast("int")),
    Indicator("tam_hogar_consistente", ("tam_hogar", "tam_hogar_mod2"), lambda a, b: flag_eq(a, b)),
    Indicator("perceptores_leq_tam_hogar", ("num_perceptores", "tam_hogar"), lambda a, b: flag(a <= b)),
)

ENGINEERED_INDICATORS: Sequence[Indicator] = (
    Indicator("personas_por_habitacion", ("tam_hogar", "num_habitaciones"), ratio),
    Indicator("proporcion_ninos_hogar", ("num_ninos_0_5", "num_ninos_6_16", "tam_hogar"),
              lambda a, b, n: F.try_divide(row_sum([a, b]), as_number(n))),
    Indicator("proporcion_sin_atencion_salud", ("num_miembros_sin_atencion_salud", "tam_hogar"), ratio),
    Indicator("transferencias_publicas_total", tuple(spec.TRANSFERS), row_sum, partial=True),
    Indicator("indice_servicios_basicos", tuple(spec.SERVICES), row_sum, partial=True),
)


def derive_household(df: DataFrame) -> DataFrame:
    """The derived indicators of a household."""
    return derive_indicators(df, HOUSEHOLD_INDICATORS)


def logical_checks(df: DataFrame) -> DataFrame:
    """Cross-column rules. A comparison with a missing side is not a violation of
    an ordering rule, but counts as a mismatch of the two household sizes."""
    size, earners, age = F.col("tam_hogar"), F.col("num_perceptores"), as_number("edad_jefe")
    return rule_violations(df, {
        "tam_hogar_ge_num_perceptores_violations": size < earners,
        "edad_jefe_outside_12_100": (age < 12) | (age > 100),
        "tam_hogar_vs_mod2_mismatches": ~F.coalesce(size == F.col("tam_hogar_mod2"), F.lit(False))})


def household_target(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Binary poverty target; rows without one are dropped and counted."""
    mapped = df.withColumn(spec.TARGET, map_values(norm_cat("pobreza"), spec.POVERTY_CODES))
    return drop_null_target(mapped, spec.TARGET)


def model_views(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Analytical view (without all-null columns), model-ready view, and why each
    column was dropped."""
    found = constant_columns(df)
    analytical = df.drop(*[c for c, why in found if why == "all_null"])
    ready, reasons = apply_drop_rules(analytical, spec.DROP_RULES, found)
    return analytical, ready, reasons


def final_dataset(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Identifiers, geography, weight, target and selected features, renamed."""
    key = spec.HOUSEHOLD_KEY
    return model_ready(df, key, ["ubigeo", *key], "hogar_id",
                       [*spec.GEO_COLUMNS, spec.WEIGHT, spec.TARGET], features, spec.FINAL_RENAMES)


def scenario_dataset(df: DataFrame, candidates: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The candidate table with programme totals under its final names."""
    raw = [*spec.PROGRAMME_TOTALS, *spec.FOOD_PROGRAMMES, *spec.OTHER_PROGRAMMES]
    filled = to_numeric(df, raw).na.fill(0.0, [c for c in raw if c in df.columns])
    key = spec.HOUSEHOLD_KEY
    return model_ready(programme_totals(filled, spec.PROGRAMMES), key, ["ubigeo", *key], "hogar_id",
                       [spec.WEIGHT, spec.TARGET], candidates, spec.RENAMES)


def clean_scenario(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scenario without redundant columns, plus the pairs that applied."""
    pairs = applicable_rules(df, spec.REDUNDANCY)
    return derive_indicators(drop_redundant(df, [d for d, _, _ in spec.REDUNDANCY]), ENGINEERED_INDICATORS), pairs
