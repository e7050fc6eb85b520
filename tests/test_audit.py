"""The whole audit over a small made-up survey, one row per behaviour."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from canvass.functions import columns as cols
from canvass.operators.formlogic import FormRule
from canvass.plans import outputs, published
from canvass.plans import reports as rp
from canvass.plans.audit import run_audit
from canvass.plans.survey import ManualInputs

BASE = {
    "id": "1", "padron_pull": "1", "manzana_pull": "7", "tecnico_pull": "Ana", "ident_enc_resp": "Eva",
    "supervisor_pull": "Sol", "day": "Mar 20, 2026", "submission_date": "Mar 20, 2026 3:00:00 PM",
    "starttime": "Mar 20, 2026 2:00:00 PM", "duration": "1200", "status_survey": "1",
    "status_survey_resp": "COMPLETA", "pub_status": "COMPLETA", "pub_comentario": "todo ok",
    "grupo_experimento": "CONTROL", "audio_encuesta": "a.mp3",
    "georeferenciacion_latitude": "-34.85", "georeferenciacion_longitude": "-56.16",
    "p10_00": "1", "p10_00_resp": "SI", "p10_09": "1", "p10_13": "1", "grupo_3": "0", "grupo_4": "1",
    "p1_06": None, "p1_08a": "3", "p1_08_resp": None, "p1_08_sel_resp": "sel", "asistencia": "1",
    "p3_07a": "98", "p1_07": "4", "p2_02": "30", "p4_04": "1", "p4_05": "1", "p5_08": "1", "p5_06": "1",
    "p7_05": "no hay agua aquí", "p11_02_nombre": None, "p11_02_apellido": "X", "p11_03a": "1",
    "nombre_contacto": "c", "telefono": "9", "fcs_1": "x1", "instance_time": "2026-03-20T15:00:00",
    "direccion": "Calle 1", "n_predio": "5", "piso": None, "apartamento": "NA",
    "referencia_padron": "", "referencia_vivienda": "rv", "fecha": "f",
    **{f"pub_{c}": None for c in ("visita", "intento", "reprogramacion", "nombre", "telf_cita", "telf_1", "telf_2", "telf_3", "form_id", "users")},
}


def submission(key, unit, **changes):
    row = {**BASE, "key": key, "padron_pull": unit, "id": unit, "p11_02_nombre": f"N{key}"}
    return {**row, **changes}


ROWS = [
    submission("ok", "1"),
    submission("closed1", "2", status_survey="1", submission_date="Mar 18, 2026 3:00:00 PM"),
    submission("closed2", "2", status_survey="4", submission_date="Mar 19, 2026 3:00:00 PM", status_survey_resp="CITA"),
    submission("refused", "3", status_survey="5", status_survey_resp="RECHAZO", p7_05="asdf"),
    submission("partial", "4", status_survey="3", status_survey_resp="PARCIALMENTE COMPLETA"),
    submission("twin1", "5", p11_02_nombre="José", p11_02_apellido="Núñez"),
    submission("twin2", "6", p11_02_nombre="JOSE", p11_02_apellido="nuñez"),
    submission("lifted", "7", p11_02_nombre="jose", p11_02_apellido="NUÑEZ"),
    submission("trash", "8", p7_05="aaaaaaaaa"),
    submission("nsnr", "9", p4_04=" 98 ", p4_05="99", p5_08="-1", p5_06="98"),
    submission("far", "10", georeferenciacion_latitude="-34.86"),
    submission("nopolygon", "11"),
    submission("nogps", "12", georeferenciacion_latitude=None),
    submission("missing", "13", p1_07=None),
    submission("black", "14"),
    submission("testday", "15", day="Mar 23, 2026"),
    submission("early", "16", submission_date="Feb 26, 2026 3:00:00 PM", starttime="Feb 26, 2026 2:00:00 PM"),
    submission("moved", "99"),
    submission("relabelled", "18", status_survey="2", status_survey_resp="OCUPANTES AUSENTES"),
    submission("forced", "19", p10_00="0", p10_00_resp="NO"),
    submission("long", "20", duration="900000"),
] + [submission(f"bulk{i}", f"u{i}", duration=str(1150 + i), p1_07=str(3 + i % 3)) for i in range(40)] + [
    submission("extreme", "21", p1_07="97", p2_02="99"),
]
RULES = [
    FormRule("p1_07", required=True, relevant="status_survey = '1'", label="Personas"),
    FormRule("p7_05", relevant="status_survey <> '5'"),
    FormRule("status_survey", relevant="p2_02 IS NULL"),
]


@pytest.fixture(scope="module")
def audit(spark):
    names = list(ROWS[0])
    schema = ", ".join(f"{n} string" for n in names)
    raw = spark.createDataFrame([tuple(r[n] for n in names) for r in ROWS], schema)
    # a box of 40 m around the common place, for all units but one
    units = [r["padron_pull"] for r in ROWS if r["padron_pull"] not in ("11", "99")] + ["17"]
    from canvass.functions.geo import with_utm

    at = with_utm(spark.createDataFrame([(-56.16, -34.85)], "lo double, la double"), "lo", "la", 21).collect()[0]
    x, y = at["utm_x"], at["utm_y"]
    ring = ", ".join(f"{x + a} {y + b}" for a, b in ((-20, -20), (20, -20), (20, 20), (-20, 20), (-20, -20)))
    polygons = spark.createDataFrame([(u, f"POLYGON (({ring}))") for u in set(units)], "padron string, wkt_geom string")
    manual = ManualInputs(
        forced_keys=["forced"], blacklist=["black"], unit_corrections=[("moved", "17")],
        status_corrections=[("relabelled", 6)], accepted_duplicates=["lifted"],
    )
    return run_audit(raw, polygons, RULES, manual=manual, labels={"p1_07": "Personas"})


@pytest.fixture(scope="module")
def rows(audit):
    return {r["key"]: r for r in audit.audited.collect()}


def test_who_is_left(audit, rows):
    keys = {r["key"] for r in audit.submissions.select("key").collect()}
    assert not keys & {"black", "testday", "early"} and {"closed1", "nogps"} <= keys
    assert "closed1" not in rows and "nogps" not in rows and "closed2" in rows
    assert [r["key"] for r in audit.superseded().collect()] == ["closed1"]


def test_corrections(audit, rows):
    assert (rows["moved"]["id"], rows["moved"]["padron_pull"]) == ("17", "17")
    assert (rows["relabelled"]["status_survey"], rows["relabelled"]["pub_status"]) == ("6", "PADRÓN DESOCUPADO")
    assert (rows["forced"]["p10_00"], rows["forced"]["p10_00_resp"]) == ("1", "SI")
    assert rows["ok"]["p1_06"] == "3" and rows["ok"]["p1_08_resp"] == "sel"
    assert rows["ok"]["fcs_1"] is None and rows["ok"]["submission_date"] == datetime(2026, 3, 20, 12)
    assert rows["closed2"]["grupo_experimento"] is None and rows["partial"]["grupo_experimento"] == "CONTROL"


def test_categories(rows):
    got = {k: rows[k]["category"] for k in ("ok", "refused", "relabelled", "closed2", "partial")}
    assert got == {
        "ok": "EFECTIVA", "refused": "RECHAZO", "relabelled": "NO ELEGIBLE",
        "closed2": "AGENDADA/PENDIENTE", "partial": "AGENDADA/PENDIENTE",
    }


def test_flags(rows):
    raised = lambda flag: {k for k, r in rows.items() if r[flag] == 1}
    assert raised("flag_duplicated") == {"twin1", "twin2"}
    assert raised("flag_garbage_text") == {"trash", "refused"}
    assert raised("flag_nsnr") == {"nsnr"}
    assert raised("flag_geofencing") == {"far"}
    assert raised("flag_missing") == {"missing"}
    assert raised("flag_duration_outlier") == {"long"}
    assert raised("flag_extreme_values") == {"extreme"}
    assert raised("flag_refusal") == {"refused"}
    assert rows["nopolygon"]["distance_m"] is None and rows["nopolygon"]["alert_geo"] is None
    assert rows["ok"]["distance_m"] == 0.0 and rows["far"]["distance_m"] > 1000
    assert rows["refused"]["s_p7_05"] == 1 and rows["ok"]["s_status_survey"] == 0
    assert rows["ok"]["total_skips"] == 1  # the ignored question still counts


def test_verdicts(rows):
    alerts = {k for k, r in rows.items() if r["audit_alert"] == 1}
    assert alerts == {"twin1", "twin2", "trash", "nsnr", "far", "missing", "long", "extreme"}
    assert not [k for k, r in rows.items() if r["audit_alert"] == 1 and r["audit_pass"] == 1]
    assert rows["refused"]["audit_pass"] == 1 and rows["refused"]["refusal_lbl"] == "Sí"
    assert rows["lifted"]["audit_pass"] == 1


def test_details(rows):
    assert rows["trash"]["garbage_detail"] == "p7_05: 'aaaaaaaaa'"
    assert rows["nsnr"]["nsnr_detail"] == "p4_04, p4_05, p5_08, p3_07a, p5_06"  # 98 counts in p3_07a too
    assert rows["extreme"]["outlier_detail"] == "Personas: [97]"
    assert rows["missing"]["missing_detail"] == "🚫 Faltante: Personas"
    assert rows["ok"]["garbage_detail"] is None


def test_alert_table(audit):
    table = {r["key"]: r for r in rp.alert_table(audit.audited, audit.survey).collect()}
    assert table["trash"]["severity"] == "🔴 CRÍTICO" and table["trash"]["action"] == "Revisar texto"
    assert table["trash"]["alerts"] == "🗑️ Basura: p7_05: 'aaaaaaaaa'"
    assert table["long"]["severity"] == "🔵 REVISIÓN" and table["long"]["alerts"] == "⏱️ Duración: 15000m"
    assert table["twin1"]["alerts"] == "👥 DUPLICADO: JOSE_NUNEZ_1"
    assert table["missing"]["action"] == "Revisar datos faltantes"
    assert table["far"]["alerts"].startswith("📍 GPS: 1") and table["far"]["alerts"].endswith("m fuera")


def test_histories(audit):
    review = rp.closure_review(audit.submissions, audit.survey)
    assert {r["key"]: r["history_alert"] for r in review.collect()} == {
        "closed1": "Seguimiento normal", "closed2": "⚠️ REVISITAR TRAS CIERRE",
    }
    assert {r["key"] for r in rp.partial_review(audit.submissions, audit.survey).collect()} == {"partial"}
    known = [(o, c) for o, c in published.CLOSURE_REVIEW if c in review.columns]
    assert cols.select_mapping(review, known).columns[:3] == ["padron", "status", "comentario"]
    partial = rp.partial_review(audit.submissions, audit.survey)
    assert cols.select_mapping(partial, published.PARTIAL_REVIEW).columns[-1] == "key"
    cases = {r["key"]: (r["attempt"], r["is_final"]) for r in rp.cases_table(audit.submissions, audit.survey).collect()}
    assert cases["closed1"][0] + cases["closed2"][0] == 3 and cases["ok"] == (1, 1)


def test_audio_coverage(audit):
    got = {r["day"]: (r["0"], r["1"]) for r in rp.audio_coverage(audit.audited, audit.survey).collect()}
    effective = audit.audited.filter("category = 'EFECTIVA'").count()
    assert got == {"Mar 20, 2026": (0, effective)}


def test_clear_table(audit):
    assert not [c for c in audit.clear.columns if c.startswith(("m_", "s_", "trash_"))]
    row = audit.clear.filter("key = 'ok'").collect()[0]
    assert row["p10_05a_label"] == "SI" and row["p3_07a"] == "NO RESPONDE"
    sheet = outputs.audited_sheet(audit.clear)
    assert {"Exito_Auditoria", "categoria_auditoria", "distancia_m", "lista_nsnr"} <= set(sheet.columns)


def test_publish_everything(spark, audit, tmp_path):
    cases = spark.createDataFrame(
        [
            ("1", "1", "7", " e7 ", "Ana", "Sol", "u7", "CITA", "f", "P", "1", "Dia: 2026-03-01 Hora: 14:30", 2),
            ("2", "2", "7", "e7", "Ana", "Sol", "u7", "CITA", "f", "P", "1", "Dia: 2030-03-01 Hora: 14:30", 3),
            ("5", "5", "8", "e8", "Ana", "Sol", "u8", "COMPLETA", "f", "P", "1", None, 1),
        ],
        "id string, padron string, manzana string, enumerators string, enumerator_name string, supervisor string, "
        "users string, status string, fecha string, nombre_participante string, telefono_1 string, cita string, intento int",
    )
    enumerators = spark.createDataFrame([("e7", "u7", "Manzana 7"), ("e8", "not_yet", "Manzana 8")], "id string, users string, name string")
    names = spark.createDataFrame([("u7", "Ana")], "users string, enumerator_name string")
    root, second = str(tmp_path / "out"), str(tmp_path / "cases2")
    households = [(o, s) for o, s in published.household_mapping() if s in audit.clear.columns]
    written = outputs.publish_run(
        audit, cases, enumerators, names, root, date(2026, 3, 25), datetime(2026, 3, 20),
        households=households, second_cases=second,
    )
    assert {"raw", "audited", "households", "cases", "daily_progress", "block_progress", "alerts", "appointments"} <= set(written)
    assert spark.read.parquet(second).count() == audit.submissions.count()
    blocks = {r["Manzana"]: r for r in spark.read.parquet(f"{root}/block_progress").collect()}
    assert blocks["Manzana 8"]["Semaforo"] == "📁 NO ASIGNADA" and blocks["Manzana 8"]["EFECTIVAS"] == 0
    # case 1 is the template and has no target
    assert blocks["Manzana 7"]["Padrones Totales"] == 1 and blocks["Manzana 7"]["Tecnico"] == "Ana"
    meetings = spark.read.parquet(f"{root}/appointments").collect()
    assert [(r["id"], r["intento_anterior"], r["alerta_cita_vencida"]) for r in meetings] == [("2", 2.0, "Pendiente")]
    # every sheet comes back in its order, with NULL last
    for name, order in published.ORDERS.items():
        sheet = spark.read.parquet(f"{root}/{name}")
        assert {n.lstrip("-") for n in order} <= set(sheet.columns), name
        keys = [[r[n.lstrip("-")] for n in order] for r in sheet.coalesce(1).collect()]
        if "-" not in "".join(order) and name != "daily_progress":
            plain = [[(v is None, "" if v is None else v) for v in k] for k in keys]
            assert plain == sorted(plain), name
        elif order[0].startswith("-") and all(isinstance(k[0], (int, float)) for k in keys):
            assert [k[0] for k in keys] == sorted((k[0] for k in keys), reverse=True), name
    assert not {"utm_x", "utm_y"} & set(spark.read.parquet(f"{root}/audited").columns)
    assert {"scheme_review", "closure_review", "partial_review", "superseded", "audio_coverage"} <= set(written)
    # the same cases in another order give the same appointments
    twice = cases.unionByName(cases.withColumn("cita", F.lit("Dia: 2020-03-01 Hora: 14:30")).where("status = 'CITA'"))
    both = [
        {tuple(r) for r in rp.appointments(c, audit.clear, datetime(2026, 3, 20), audit.survey).collect()}
        for c in (twice.orderBy("cita"), twice.orderBy(F.desc("cita")))
    ]
    assert both[0] == both[1]
    assert spark.read.csv(f"{root}/clean/run_date=2026-03-25", header=True).count() == audit.audited.filter("audit_pass = 1").count()
    refreshed = rp.case_refresh(
        cases.withColumns({c: F.lit(None).cast("string") for c in rp.CASE_REFRESH if c not in cases.columns}),
        audit.raw.filter("key <> 'closed1'"),
    )
    row = {r["id"]: r for r in refreshed.collect()}
    assert row["1"]["direccion"] == "Calle 1 5 Piso Apartamento Ref padrón Ref vivienda rv"
    assert row["1"]["status"] == "COMPLETA" and row["1"]["cita"] == "Dia: 2026-03-01 Hora: 14:30"
    assert refreshed.columns[: len(cases.columns)] == cases.columns


def test_household_mapping_is_complete():
    pairs = published.household_mapping()
    assert len(pairs) == 150 and len({o for o, _ in pairs}) == 150
