"""Names, labels, boundaries and patterns that results must carry verbatim."""

from __future__ import annotations

# Columns of a raw readings file, in file order.
RAW_COLUMNS = [
    "id",
    "fecha",
    "tipo_elem",
    "intensidad",
    "ocupacion",
    "carga",
    "vmed",
    "error",
    "periodo_integracion",
]

# Separator, patterns, valid quality flag and year range.
RAW_SEPARATOR = ";"
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
DAY_PATTERN = "yyyy-MM-dd"
VALID_FLAG = "N"
FIRST_YEAR = 2019
LAST_YEAR = 2022

# Named periods with their last day (inclusive), then the open-ended one.
CLOSED_PERIODS = [
    ("Pre-COVID", "2020-03-14"),
    ("Confinamiento", "2020-06-21"),
    ("Desescalada", "2020-10-25"),
    ("2º estado de alarma", "2021-05-09"),
]
OPEN_PERIOD = "Post-restricciones"
BASELINE_PERIOD = "Pre-COVID"

# Day types in logical order (Monday to Friday, Saturday, Sunday).
WEEKDAY_TYPE = "Laborable"
SATURDAY_TYPE = "Sábado"
SUNDAY_TYPE = "Domingo"
DAY_TYPES = [WEEKDAY_TYPE, SATURDAY_TYPE, SUNDAY_TYPE]

# Directory names of the four first-tier tables.
SUMMARY_TABLE = "resumen_periodos"
MONTHLY_TABLE = "intensidad_mensual"
HOURLY_TABLE = "curva_horaria"
DAILY_TABLE = "intensidad_diaria"

# Table names of the report, four base tables and five derived ones.
REPORT_SUMMARY = "Resumen_periodos"
REPORT_MONTHLY = "Intensidad_mensual"
REPORT_HOURLY = "Curva_horaria"
REPORT_DAILY = "Intensidad_diaria"
REPORT_ANNUAL = "Intensidad_anual"
REPORT_DAY_TYPE = "Laboral_vs_findes"
REPORT_TOP = "Top10_dias_mas"
REPORT_BOTTOM = "Top10_dias_menos"
REPORT_COMPARISON = "Comparativa_Pre_Post"
TOP_N = 10
DECIMALS = 2
