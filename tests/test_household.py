import pytest
from pyspark.sql import functions as F

from surveyloom import plans
from surveyloom.plans import survey_spec as spec


def tables(spark):
    hh = [("c1", "1", "1"), ("c1", "2", "1"), ("c2", "1", "1"), ("c3", "1", "1")]
    code = ["40101", "040102", "0401011", "150101"]
    summary = spark.createDataFrame(
        [(*h, u, m, p, i, 900.0, pov, est, 1.5, t1, 0.0) for h, u, m, p, i, pov, est, t1 in zip(
            hh, code, [3.0, 2.0, 1.0, 4.0], [1.0, 2.0, 2.0, 1.0], [1200.0, None, 300.0, 50.0],
            ["No pobre ", "pobre extremo", "Pobre no extremo", "otro"], ["Area rural", "2,000 viviendas", None, "x"],
            [100.0, None, 0.0, 3.0])],
        "conglome string, vivienda string, hogar string, ubigeo string, mieperho double, percepho double, inghog1d double, "
        "gashog2d double, pobreza string, estrato string, factor07 double, ingtpu01 double, sg27 double")
    dwelling = spark.createDataFrame(
        [(*h, u, fl, w, "si", "Leña", " Red Publica ") for h, u, fl, w in zip(
            hh, code, ["Tierra", None, "cemento", "tierra"], ["Red publica, dentro", "rio", None, "x"])],
        "conglome string, vivienda string, hogar string, ubigeo string, p103 string, p110 string, p110a1 string, "
        "p113a string, p111a string")
    people = [(*hh[0], "1", "Jefe/Jefa", "hombre", 44.0), (*hh[0], "2", "hijo", "mujer", 5.0), (*hh[0], "3", "hijo", "mujer", 16.0),
              (*hh[1], "2", "jefe", "mujer", 65.0), (*hh[1], "1", "jefe", "hombre", 64.0), (*hh[1], "3", "hijo", "hombre", None),
              (*hh[2], "1", "otro", "hombre", 17.0)]
    roster = spark.createDataFrame(people, "conglome string, vivienda string, hogar string, codperso string, p203 string, "
                                           "p207 string, p208a double")
    education = spark.createDataFrame(
        [(*hh[0], "1", 6.0, 1.0, None), (*hh[0], "3", 5.0, 2.0, 2.0), (*hh[1], "1", 10.0, None, None), (*hh[1], "2", 1.0, None, None)],
        "conglome string, vivienda string, hogar string, codperso string, p301a double, p306 double, p307 double").withColumns(
        {"p301b": F.lit(1.0), "p301c": F.lit(None).cast("double")})
    health = spark.createDataFrame(
        [(*hh[0], "1", "pase", None, " Pase ", None, "essalud"), (*hh[0], "2", "tos", "gripe", "no", None, "no"),
         (*hh[1], "1", None, "none", "", "nan", None)],
        "conglome string, vivienda string, hogar string, codperso string, p4021 string, p4022 string, p4091 string, "
        "p4092 string, p4191 string")
    employment = spark.createDataFrame(
        [(*hh[0], "1", 800.0, None), (*hh[0], "2", 0.0, None), (*hh[1], "2", None, 5.0)],
        "conglome string, vivienda string, hogar string, codperso string, p524a1 double, p530a double")
    return {"dwelling": dwelling, "roster": roster, "education": education, "health": health,
            "employment": employment, "summary": summary}


@pytest.fixture(scope="module")
def household(spark):
    base, reports = plans.build_household(**tables(spark))
    return plans.derive_household(base).cache(), reports


def by_key(df):
    return {(r["conglome"], r["vivienda"]): r for r in df.collect()}


def test_rollups_and_head(household):
    rows = by_key(household[0])
    a, b, c, d = rows["c1", "1"], rows["c1", "2"], rows["c2", "1"], rows["c3", "1"]
    assert (a["tam_hogar_mod2"], a["n_ninos_0_5"], a["n_ninos_6_16"], a["n_adultos_65_mas"]) == (3, 1, 1, 0)
    assert (a["sexo_jefe"], a["edad_jefe"], a["num_jefes_detectados"]) == ("hombre", 44.0, 1)
    assert (b["sexo_jefe_bin"], b["edad_jefe"], b["num_jefes_detectados"], b["n_adultos_65_mas"]) == (1, 64.0, 2, 1)
    assert (c["sexo_jefe"], c["num_jefes_detectados"]) == (None, 0)
    assert d["tam_hogar_mod2"] is None and d["jefe_hogar"] is None
    assert (a["n_6_16_total"], a["n_6_16_no_matriculados"], a["any_6_16_no_asisten"]) == (1, 1, 1)
    assert (a["educ_jefe"], b["educ_jefe_nivel"]) == ("secundaria completa", 10.0)
    assert (a["miembros_con_sintoma_4w"], a["any_sin_atencion_salud"], a["miembros_afiliados_essalud"]) == (1, 1, 1)
    # 'none' is a skip code for the care reasons only; as an illness it counts as an answer
    assert (b["any_sin_atencion_salud"], b["any_enfermedad_4w"]) == (0, 1)
    assert (a["miembros_con_ingreso_laboral"], a["jefe_con_ingreso_laboral"]) == (1, 1)
    assert (b["miembros_con_ingreso_laboral"], b["jefe_con_ingreso_laboral"], b["any_ingreso_laboral_hogar"]) == (1, 0, 1)


def test_indicators(household):
    rows = by_key(household[0])
    a, b, c = rows["c1", "1"], rows["c1", "2"], rows["c2", "1"]
    assert (a["ubigeo"], a["departamento_cod"], a["provincia_cod"]) == ("040101", "04", "0401")
    assert (a["piso_precario"], b["piso_precario"], b["material_piso"]) == (1, 0, None)
    assert (a["acceso_agua_red"], a["agua_segura_proxy"], c["acceso_agua_red"]) == (1, 1, 0)
    assert a["combustible_precario"] == 1 and a["acceso_desague_red"] == 1
    assert (a["area_urbana_rural"], c["area_urbana_rural"], a["area_rural_bin"]) == ("rural", "urbana", 1)
    assert (a["ingreso_percapita"], b["ingreso_percapita"]) == (400.0, None)
    assert (a["health_no_attention"], c["health_no_attention"], c["children_not_enrolled"]) == (1, 0, 0)
    assert (a["tam_hogar_consistente"], rows["c3", "1"]["tam_hogar_consistente"]) == (1, 0)


def test_audits(household):
    audit = {r["merge_name"]: r for r in household[1]["merge_audit"].collect()}
    assert audit["modulo02_roster"]["addon_rows"] == 3 and audit["modulo02_roster"]["rows_after_merge"] == 4
    assert all(r["duplicated_after_merge"] == 0 for r in audit.values())
    assert household[1]["chief_audit"].count() == 2
    checks = {r["rule"]: r["violations"] for r in plans.logical_checks(household[0]).collect()}
    assert checks == {"tam_hogar_ge_num_perceptores_violations": 1, "edad_jefe_outside_12_100": 0,
                      "tam_hogar_vs_mod2_mismatches": 2}


def test_duplicate_household_raises(spark):
    t = tables(spark)
    t["summary"] = t["summary"].union(t["summary"].limit(1))
    with pytest.raises(Exception, match="not unique"):
        plans.build_household(**t)[0].collect()


def test_target_views_and_scenario(spark, household):
    with_target, audit = plans.household_target(household[0])
    assert sorted(r[spec.TARGET] for r in with_target.collect()) == [0, 1, 1]
    assert audit.first()["null_targets"] == 1
    _analytical, ready, reasons = plans.model_views(with_target)
    kinds = {r["variable"]: r["kind"] for r in reasons.collect()}
    assert kinds["pobreza"] == "leakage" and kinds["mieperho"] == "redundant" and kinds["conglome"] == "identifier"
    assert "pobreza" not in ready.columns and spec.TARGET in ready.columns
    final, report = plans.final_dataset(with_target, ["educ_jefe_ord", "tam_hogar", "absent"])
    assert final.columns[:4] == ["hogar_id", "conglome", "vivienda", "hogar"]
    assert "nivel_educativo_jefe_ord" in final.columns and "target_pobreza_monetaria_bin" in final.columns
    assert "040101_c1_1_1" in [r["hogar_id"] for r in final.collect()]
    scenario, _ = plans.scenario_dataset(with_target, ["internet_hogar", "ingtpu01", "health_no_attention", "tam_hogar",
                                                       "monto_programas_sociales_no_alimentarios",
                                                       "recibe_programa_social_no_alimentario"])
    clean, pairs = plans.clean_scenario(scenario)
    assert "monto_juntos" in clean.columns and "recibe_programa_social_no_alimentario" not in clean.columns
    assert pairs.count() == 3 and "transferencias_publicas_total" in clean.columns


def test_region_and_profiles(spark):
    kept, audit = plans.select_region({"s": tables(spark)["summary"], "r": tables(spark)["roster"]}, "04")
    assert kept["s"].count() == 3 and kept["r"].count() == 7
    assert all(r["all_match"] for r in audit.collect())
    clean, reports = plans.profile_tables({"Roster": tables(spark)["roster"].withColumnRenamed("p207", "P207 ")})
    assert "p207" in clean["Roster"].columns
    assert reports["schema_summary"].first()["grain"] == "persona"
    assert reports["key_audit"].filter("is_unique").count() == 1
