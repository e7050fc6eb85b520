"""Headings of the published sheets: ``(heading, column)`` pairs for ``select_mapping``."""

# Sheet headings.
ALERT_TABLE = [
    ("Status", "severity"),
    ("ID Encuesta", "key"),
    ("Fecha", "started"),
    ("Supervisor", "supervisor"),
    ("Tecnico", "agent"),
    ("Encuestador", "interviewer"),
    ("Manzana", "block"),
    ("Padron", "unit"),
    ("Tipo de encuesta", "category"),
    ("Accion", "action"),
    ("Alertas Detalladas", "alerts"),
]
BLOCK_SCORECARD = [
    ("Manzana", "block"),
    ("Total_Padrones_Visitados", "units_visited"),
    ("Total_Efectivas", "effective"),
    ("Alertas_GPS", "alerts_gps"),
    ("Alertas_Texto_Basura", "alerts_garbage"),
    ("Alertas_Tiempos", "alerts_time"),
    ("Alertas_Duplicados", "alerts_duplicates"),
    ("Alertas_NSNR", "alerts_nsnr"),
    ("Alertas_Valores_Extremos", "alerts_outliers"),
    ("Promedio_Missings", "mean_missing"),
    ("Promedio_Saltos", "mean_skips"),
    ("Encuestas_Con_Alerta", "with_alert"),
    ("Encuestas_Exitosas", "passed"),
    ("Indice_Calidad", "quality_index"),
    ("Supervisor", "supervisor"),
    ("Equipos", "teams"),
    ("Estado_Auditoria", "quality_band"),
]
BLOCK_PROGRESS = [
    ("Manzana", "block"),
    ("Supervisor", "supervisor"),
    ("Tecnico", "agent"),
    ("Encuestadores", "interviewers"),
    ("Padrones Totales", "units_total"),
    ("No Visitados", "not_visited"),
    ("EFECTIVAS", "effective"),
    ("RECHAZOS", "refusals"),
    ("NO_ELEGIBLES", "not_eligible"),
    ("AGENDADAS", "scheduled"),
    ("Alertas de Auditoría", "in_review"),
    ("% Recorrido", "percent_visited"),
    ("% Avance real", "percent_progress"),
    ("Primera Visita", "first_visit"),
    ("Última Visita", "last_visit"),
    ("Días Activos (Duración)", "days_active"),
    ("Días Inactiva (Desde última)", "days_idle"),
    ("Alertas_Manzana", "block_alerts"),
    ("Semaforo", "light"),
]
AGENT_CONSOLIDATED = [
    ("Técnico", "agent"),
    ("Encuestador", "interviewer"),
    ("Manzanas", "blocks"),
    ("Metas (Asignados)", "target"),
    ("EFECTIVAS CON ALERTA", "effective_with_alert"),
    ("EFECTIVAS", "effective"),
    ("RECHAZOS", "refusals"),
    ("NO_ELEGIBLES", "not_eligible"),
    ("AGENDADAS", "scheduled"),
    ("OTROS_ERRORES", "others"),
    ("Total Alertas (Histórico)", "all_alerts"),
    ("% Avance Cobertura", "coverage"),
    ("Supervisor", "supervisor"),
]
AGENT_PRODUCTIVITY = [
    ("Tecnico", "agent"),
    ("Encuestador", "interviewer"),
    ("Total_Padrones", "units"),
    ("EFECTIVAS", "effective"),
    ("RECHAZOS", "refusals"),
    ("NO_ELEGIBLES", "not_eligible"),
    ("AGENDADAS", "scheduled"),
    ("Minutos_Promedio", "mean_minutes"),
    ("Esquemas_Simples_Ok", "simple_schemes"),
    ("Esquemas_Detallados_Ok", "detailed_schemes"),
    ("Alertas_GPS", "alerts_gps"),
    ("Alertas_Tiempo", "alerts_time"),
    ("Alertas_Basura", "alerts_garbage"),
    ("Alertas_NSNR", "alerts_nsnr"),
    ("Alertas_Outlier_Num", "alerts_outliers"),
    ("Alertas_Duplicados", "alerts_duplicates"),
    ("Alertas_missings", "alerts_missing"),
    ("Tasa_Error_Efectivas", "error_rate"),
]
AGENT_REPORT = [
    ("Técnico", "agent"),
    ("# Manzanas", "blocks"),
    ("Padrones Totales", "units_total"),
    ("Padrones Visitados", "units_visited"),
    ("% Recorrido", "percent_visited"),
    ("% Avance Real", "percent_progress"),
    ("Tasa de efectividad", "effectiveness"),
    ("# de citas", "appointments"),
    ("# padrones con ocupantes ausentes", "absent"),
]
APPOINTMENTS = [
    ("id", "id"),
    ("tecnico", "agent"),
    ("manzana", "manzana"),
    ("fecha", "fecha"),
    ("nombre_participante", "nombre_participante"),
    ("telefono_1", "telefono_1"),
    ("cita", "cita"),
    ("comentarios_completos", "full_comment"),
    ("intento_anterior", "previous_attempt"),
    ("alerta_cita_vencida", "overdue"),
]
CASES = [
    ("id_padron", "unit"),
    ("manzana", "block"),
    ("key", "key"),
    ("fecha_visita", "visited_at"),
    ("supervisor", "supervisor"),
    ("tecnico", "agent"),
    ("encuestador", "interviewer"),
    ("status", "status"),
    ("resultado_visita", "result"),
    ("intento", "attempt"),
    ("encuesta_final", "is_final"),
]
CLOSURE_REVIEW = [
    ("padron", "padron_pull"),
    ("status", "category"),
    ("comentario", "pub_comentario"),
    ("fecha_envio", "submission_date"),
    ("fecha_inicio", "starttime"),
    ("day", "day"),
    ("alerta", "history_alert"),
    ("tecnico_pull", "tecnico_pull"),
    ("grupo_experimento", "grupo_experimento"),
    ("p11_02_nombre", "p11_02_nombre"),
    ("p2_02", "p2_02"),
    ("pub_direccion", "pub_direccion"),
    ("key", "key"),
]
PARTIAL_REVIEW = [
    ("id_padron", "padron_pull"),
    ("fecha", "starttime"),
    ("tecnico", "tecnico_pull"),
    ("encuestador", "ident_enc_resp"),
    ("status", "status_survey_resp"),
    ("status_num", "status_num"),
    ("grupo_experimento", "grupo_experimento"),
    ("comentario", "pub_comentario"),
    ("key", "key"),
]
SCHEME_REVIEW = {
    "PADRÓN": "padron_pull",
    "FECHA": "day",
    "SUPERVISOR": "supervisor_pull",
    "TÉCNICO": "tecnico_pull",
    "ENCUESTADOR": "ident_enc_resp",
    "FUENTE": "fuente_resp",
    "TIPO DE CONEXIÓN": "p10_09_resp",
    "TIPO DE ESQUEMA": "grupo_experimento",
    "FOTO FRENTE ESQUEMA": "foto_ef_anverso",
    "FOTO REVERSO ESQUEMA": "foto_ef_reverso",
}
SCHEME_REVIEW_BLANKS = ("STATUS DE REVISIÓN", "COMENTARIOS DE LA ARQUI")
SCHEME_REVIEW_FLAGS = ("grupo_3", "grupo_4")

# Audited columns under their published names.
AUDITED = {
    "is_effective": "es_efectiva",
    "is_refusal": "es_rechazo",
    "is_not_eligible": "es_no_elegible",
    "is_scheduled": "es_agendada",
    "category": "categoria_auditoria",
    "is_final": "encuesta_final",
    "has_audio": "tiene_audio",
    "group_mean": "media_grupo",
    "group_sd": "sd_grupo",
    "threshold_short": "umbral_corto",
    "threshold_long": "umbral_excesivo",
    "alert_short": "alerta_corto",
    "alert_long": "alerta_excesivo",
    "total_skips": "total_saltos",
    "total_extremes": "total_extremos",
    "identity": "id_unico",
    "identity_name": "nombre_dup",
    "distance_m": "distancia_m",
    "alert_geo": "alerta_geo",
    "questions_seen": "preguntas_vistas",
    "nsnr_rate": "tasa_nsnr",
    "nsnr_threshold": "umbral_dinamico",
    "alert_nsnr": "alerta_exceso_nsnr",
    "total_garbage_text": "total_texto_basura",
    "flag_garbage_text": "flag_texto_basura",
    "flag_refusal": "flag_rechazo",
    "flag_skips": "flag_saltos",
    "audit_pass": "Exito_Auditoria",
    "audit_alert": "Alerta_Auditoria",
    "refusal_lbl": "Rechazo_lbl",
    "abnormal_time_lbl": "Tiempos_Anomalos_lbl",
    "repeated_id_lbl": "ID_Repetido_lbl",
    "out_of_range_lbl": "Fuera_Rango_Geo_lbl",
    "nsnr_excess_lbl": "Exceso_NSNR_lbl",
    "has_missing_lbl": "Tiene_Missings_lbl",
    "has_skips_lbl": "Tiene_Saltos_lbl",
    "garbage_text_lbl": "Contenido_basura_lbl",
    "garbage_detail": "texto_detalle_trash",
    "outlier_detail": "detalle_outliers",
    "nsnr_detail": "lista_nsnr",
    "missing_detail": "detalle_missings",
    "comment_clean": "comentario_clean",
    "comment_code": "status_comentario_num",
    "comment_label": "status_comentario_label",
}

# Order of the published sheets, "-" before a heading for descending. The last
# headings make the order full where the published one leaves ties.
ORDERS = {
    "alerts": ["Alertas Detalladas", "-Tipo de encuesta", "ID Encuesta"],
    "block_scorecard": ["Indice_Calidad", "Manzana"],
    "block_progress": ["-% Recorrido", "Semaforo", "Manzana"],
    "agent_consolidated": ["Técnico", "Encuestador"],
    "agent_productivity": ["-EFECTIVAS", "Tecnico", "Encuestador"],
    "agent_report": ["-% Avance Real", "Técnico"],
    "appointments": ["tecnico", "id"],
    "cases": ["id_padron", "-fecha_visita", "key"],
    "scheme_review": ["FECHA", "PADRÓN"],
    "daily_progress": ["Indicador"],
    "intervention_by_agent": ["-total"],
    "findings": ["padron_pull", "finding"],
    "question_outliers": ["-outliers", "question"],
    "question_nsnr": ["-total_nsnr", "question"],
}

# Columns of the clean household table, "output" or "output source".
HOUSEHOLD_COLUMNS = """
day
key
padron padron_pull
manzana manzana_pull
tecnico tecnico_pull
supervisor supervisor_pull
encuestador ident_enc_resp
submission_date
latitude georeferenciacion_latitude
longitude georeferenciacion_longitude
altitude georeferenciacion_altitude
precision georeferenciacion_accuracy
p1_01 p1_01_resp
p1_02 p1_02_resp
p1_03 p1_03_resp
p1_04 p1_04_resp
p1_05 p1_05_resp
p1_06
p1_07
p1_08 p1_08_resp
direccion
n_predio
piso
apartamento
referencia_padron
referencia_vivienda
p1_10 p1_10_resp
p1_11 p1_11_resp
p1_12 p1_12_resp
p2_01 p2_01_resp
p2_02
p2_03 p2_03_resp
p2_04 p2_04_resp
p2_05 p2_05_resp
p3_01 p3_01_resp
p3_02 p3_02_resp
p3_02_otro
p3_03 p3_03_resp
p3_04 p3_04_resp
p3_05 p3_05_resp
p3_06
p3_07a
p3_07b
p3_07c
p3_07d
p3_07e
p3_07f
p3_07g
p3_07h
p3_07i
p3_07j
p4_01
p4_02
p4_03
p4_04
p4_05 p4_05_resp
p5_01 p5_01_resp
p5_02 p5_02_resp
p5_02a p5_02a_resp
p5_03 p5_03_resp
p5_04 p5_04_resp
p10_00 p10_00_resp
p10_01 p10_01_resp
p10_02 p10_02_resp
p10_03
p10_04 p10_04_resp
p10_05 p10_05_resp
p10_05a p10_05a_label
p10_06 p10_06_resp
p10_06a
p10_08 p10_08_resp
fuente fuente_resp
p10_09 p10_09_resp
p10_09a p10_09a_resp
grupo_experimento
p5_06 p5_06_resp
p5_07 p5_07_res
p5_08 p5_08_resp
p5_09
p5_11 p5_11_resp
p5_11_otro
p5_12 p5_12_resp
p5_14 p5_14_resp
p5_15 p5_15_resp
p5_16 p5_16_resp
p5_17a p5_17_a
p5_17b p5_17_b
p5_17c p5_17_c
p5_17d p5_17_d
p5_17z p5_17_z
p5_17_otro
p5_18 p5_18_resp
p5_19
p5_20 p5_20_resp
p6_01 p6_01_resp
p6_02 p6_02_resp
p6_02_otro
p7_01 p7_01_resp
p7_02a p7_02_a
p7_02b p7_02_b
p7_02c p7_02_c
p7_02d p7_02_d
p7_02e p7_02_e
p7_02f p7_02_f
p7_02g p7_02_g
p7_02h p7_02_h
p7_02z p7_02_z
p7_02_otro
p7_03 p7_03_resp
p7_04 p7_04_resp
p7_05
p8_01
p8_02 p8_02_resp
p8_03
p9_01a p9_01_a
p9_01b p9_01_b
p9_01c p9_01_c
p9_01d p9_01_d
p9_01e p9_01_e
p9_01f p9_01_f
p9_01g p9_01_g
p9_01h p9_01_h
p9_01i p9_01_i
p9_01j p9_01_j
p9_01k p9_01_k
p9_01_otro
p9_02a p9_02_a
p9_02b p9_02_b
p9_02c p9_02_c
p9_02d p9_02_d
p9_02e p9_02_e
p9_02f p9_02_f
p9_02z p9_02_z
p9_02_otro
p9_03 p9_03_resp
p10_10 p10_10_resp
p10_11 p10_11_resp
p10_12 p10_12_resp
p10_13 p10_13_resp
p11_01 p11_01_resp
p11_02_nombre
p11_02_apellido
p11_03a
p11_03b
p11_04 p11_04_resp
p11_05 p11_05_resp
p12_01 p12_01_resp
status_survey status_survey_resp
obs_finales
categoria_auditoria category
"""


def household_mapping() -> list[tuple[str, str]]:
    """``(output, source)`` pairs of the clean household table."""
    pairs = []
    for line in HOUSEHOLD_COLUMNS.split("\n"):
        words = line.split()
        if words:
            pairs.append((words[0], words[-1]))
    return pairs
