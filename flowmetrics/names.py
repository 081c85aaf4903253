"""Column names of readings and of result tables, as parameters with defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ReadingColumns:
    """Roles of the columns of a raw readings table; ``flag=None`` means no quality flag."""

    time: str = "fecha"
    value: str = "intensidad"
    flag: str | None = "error"


@dataclass(frozen=True)
class Names:
    """Column names of clean readings and result tables."""

    time: str = "ts"
    value: str = "value"
    year: str = "year"
    month: str = "month"
    hour: str = "hour"
    day: str = "fecha_dia"
    period: str = "periodo_covid"
    mean: str = "intensidad_media"
    median: str = "intensidad_mediana"
    day_mean: str = "intensidad_media_dia"
    annual_mean: str = "intensidad_media_anual"
    annual_change: str = "variacion_pct_vs_anio_anterior"
    day_type: str = "tipo_dia"
    baseline_change: str = "variacion_vs_PreCOVID_pct"


READING_COLUMNS = ReadingColumns()
NAMES = Names()
