"""Scan, cleaning, period labels and the four aggregates on hand-written rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException

from flowmetrics import DEFAULT_CALENDAR as CALENDAR
from flowmetrics import PeriodCalendar, ReadingColumns, fixed
from flowmetrics import functions as fx
from flowmetrics import operators as op
from flowmetrics.sources import read_delimited
from pyspark.sql import functions as F

HEADER = ";".join(fixed.RAW_COLUMNS)

# time, value, flag, period or None where the row is dropped
EDGES = [
    ("2018-12-31 23:45:00", "10", "N", None),
    ("2019-01-01 00:00:00", "10", "N", "Pre-COVID"),
    ("2020-03-14 23:59:59", "10", "N", "Pre-COVID"),
    ("2020-03-15 00:00:00", "10", "N", "Confinamiento"),
    ("2020-06-21 23:45:00", "10", "N", "Confinamiento"),
    ("2020-06-22 00:00:00", "10", "N", "Desescalada"),
    ("2020-10-25 23:59:59", "10", "N", "Desescalada"),
    ("2020-10-26 00:00:00", "10", "N", "2º estado de alarma"),
    ("2021-05-09 23:59:59", "10", "N", "2º estado de alarma"),
    ("2021-05-10 00:00:00", "10", "N", "Post-restricciones"),
    ("2022-12-31 23:59:59", "10", "N", "Post-restricciones"),
    ("2023-01-01 00:00:00", "10", "N", None),
    ("not-a-date", "10", "N", None),
    ("2019-02-30 00:00:00", "10", "N", None),
    ("2019-05-01 08:00:00", "", "N", None),
    ("2019-05-01 08:00:00", "abc", "N", None),
    ("2019-05-01 08:00:00", "NaN", "N", None),
    ("2019-05-01 08:00:00", "0", "N", "Pre-COVID"),
    ("2019-05-01 08:00:00", "10", "S", None),
    ("2019-05-01 08:00:00", "10", "", None),
    ("2021-03-28 02:30:00", "10", "N", "2º estado de alarma"),
]
KEPT = sorted((t, float(v), p) for t, v, _, p in EDGES if p)


def write_edges(folder):
    folder.mkdir(parents=True)
    rows = [f"{i};{t};URB;{v};1;2;3.5;{f};15" for i, (t, v, f, _) in enumerate(EDGES)]
    (folder / "one.csv").write_text("\n".join([HEADER, *rows[:10]]) + "\n", encoding="utf-8")
    (folder / "two.csv").write_text("\n".join([HEADER, *rows[10:]]) + "\n", encoding="utf-8")


def labelled(df):
    rows = df.selectExpr("CAST(ts AS STRING)", "value", "periodo_covid").collect()
    return sorted(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def raw_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    write_edges(root / "2019_2022")
    return root


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_edges_from_csv(spark, raw_root, zone):
    """No time zone moves a reading, not even into an hour that a clock change skips."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = read_delimited(spark, f"{raw_root}/*/*.csv")
        assert labelled(op.prepare_readings(raw)) == KEPT
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris"])
def test_edges_from_text_columns(spark, zone):
    rows = [(t, v or None, f or None) for t, v, f, _ in EDGES]
    raw = spark.createDataFrame(rows, "fecha string, intensidad string, error string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert labelled(op.prepare_readings(raw)) == KEPT
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_edges_from_inferred_types(spark, tmp_path):
    folder = tmp_path / "x"
    folder.mkdir()
    good = [r for r in EDGES if r[3]]
    lines = [f"{i};{t};URB;{v};1;2;3.5;{f};15" for i, (t, v, f, _) in enumerate(good)]
    (folder / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    raw = read_delimited(spark, str(folder), infer=True)
    assert dict(raw.dtypes)["fecha"].startswith("timestamp")
    assert labelled(op.prepare_readings(raw)) == KEPT


def test_other_pattern(spark):
    raw = spark.createDataFrame(
        [("01/02/2020 03:04", 1.0), ("2020-01-01 00:00:00", 1.0), ("01/02/2024 03:04", 1.0)],
        "fecha string, intensidad double",
    )
    columns = ReadingColumns(flag=None)
    out = op.clean_readings(raw, columns, pattern="dd/MM/yyyy HH:mm").collect()
    assert [r.ts for r in out] == [datetime(2020, 2, 1, 3, 4)]


def test_permuted_header_is_an_error(spark, tmp_path):
    cols = list(fixed.RAW_COLUMNS)
    cols[1], cols[3] = cols[3], cols[1]
    (tmp_path / "a.csv").write_text(f"{';'.join(cols)}\n1;2;a;2020-01-01 00:00:00;1;1;1;N;15\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        op.prepare_readings(read_delimited(spark, str(tmp_path))).collect()


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="fecha"):
        op.clean_readings(df)
    with pytest.raises(ValueError, match="tipo_elem"):
        op.prune_columns(df)
    with pytest.raises(AnalysisException):
        op.add_calendar(df)


def test_no_flag_column_keeps_every_flag(spark):
    raw = spark.createDataFrame(
        [("2019-05-01 08:00:00", "1", "S"), ("2019-05-01 08:00:00", "2", None)],
        "fecha string, intensidad string, error string",
    )
    assert op.clean_readings(raw, ReadingColumns(flag=None)).count() == 2


def test_date_and_zoned_timestamp_columns(spark):
    df = spark.sql(
        "SELECT DATE'2020-06-21' AS d, TIMESTAMP'2020-06-21 10:00:00' AS t, 1.0D AS v UNION ALL "
        "SELECT DATE'2023-01-01', TIMESTAMP'2023-01-01 00:00:00', 1.0D"
    )
    for column, hour in (("d", 0), ("t", 10)):
        rows = op.prepare_readings(df, ReadingColumns(column, "v", None)).collect()
        assert [(r.hour, r.periodo_covid) for r in rows] == [(hour, "Confinamiento")]


def test_calendar_parts(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-12-31 23:59:59' AS ts")
    r = op.add_calendar(df).first()
    assert (r.year, r.month, r.hour, r.fecha_dia) == (2020, 12, 23, date(2020, 12, 31))


def test_weekdays(spark):
    df = spark.sql("SELECT explode(array('2020-03-14', '2020-03-15', '2020-03-16', 'no')) AS t")
    day = fx.parse_day(F.col("t"))
    rows = df.select(fx.weekday_number(day), fx.day_type(day)).collect()
    assert [tuple(r) for r in rows[:3]] == [(5, "Sábado"), (6, "Domingo"), (0, "Laborable")]
    assert rows[3][0] is None


def test_aggregates(spark):
    raw = spark.createDataFrame(
        [
            ("2019-01-01 00:00:00", 1.0),
            ("2019-01-01 00:15:00", 2.0),
            ("2019-01-01 05:00:00", 6.0),
            ("2020-04-01 05:00:00", 10.0),
        ],
        "fecha string, intensidad double",
    )
    readings = op.prepare_readings(raw, ReadingColumns(flag=None))
    for kind in ("approx", "exact"):
        rows = op.period_summary(readings, kind).collect()
        assert [tuple(r) for r in rows] == [("Confinamiento", 10.0, 10.0), ("Pre-COVID", 3.0, 2.0)]
    assert [tuple(r) for r in op.monthly_mean(readings).collect()] == [
        (2019, 1, 3.0),
        (2020, 4, 10.0),
    ]
    assert [tuple(r) for r in op.hourly_curve(readings).collect()] == [
        ("Confinamiento", 5, 10.0),
        ("Pre-COVID", 0, 1.5),
        ("Pre-COVID", 5, 6.0),
    ]
    assert [tuple(r) for r in op.daily_mean(readings).collect()] == [
        (date(2019, 1, 1), 3.0),
        (date(2020, 4, 1), 10.0),
    ]
    with pytest.raises(ValueError, match="approx"):
        op.period_summary(readings, "mode")


def test_calendar_must_be_in_order():
    with pytest.raises(ValueError, match="ascending"):
        PeriodCalendar.of([("a", "2020-01-02"), ("b", "2020-01-01")], "c")
    with pytest.raises(ValueError, match="unique"):
        PeriodCalendar.of([("a", "2020-01-02")], "a")


def test_calendar_frame(spark):
    rows = CALENDAR.frame(spark).collect()
    assert [r.label for r in rows] == CALENDAR.labels
    assert rows[0].first_day is None and rows[-1].last_day is None
    assert all((b.first_day - a.last_day).days == 1 for a, b in zip(rows, rows[1:]))


def test_null_day_gets_the_open_label(spark):
    df = spark.sql("SELECT CAST(NULL AS DATE) AS fecha_dia")
    for label in (op.label_period, op.label_period_by_join):
        assert label(df).first().periodo_covid == CALENDAR.open_label


def test_calendar_without_closed_periods(spark):
    only = PeriodCalendar.of([], "all")
    df = spark.sql("SELECT DATE'2020-01-01' AS fecha_dia")
    for label in (op.label_period, op.label_period_by_join):
        assert label(df, only).first().periodo_covid == "all"


def test_a_calendar_of_many_periods_needs_no_join(spark):
    """Weekly periods over three years: a nested choice moves no row, and says what the join says."""
    ends = [date(2019, 6, 1) + timedelta(weeks=w) for w in range(150)]
    weekly = PeriodCalendar.of([(f"w{i}", e) for i, e in enumerate(ends)], "later")
    raw = spark.range(0, 1400).selectExpr(
        "TIMESTAMP_NTZ'2019-02-01 12:00:00' + make_interval(0, 0, 0, id) AS fecha",
        "1.0D AS intensidad",
        "'N' AS error",
    )
    readings = op.prepare_readings(raw, calendar=weekly)
    text = readings._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text
    days = readings.select("fecha_dia")
    assert op.label_period_by_join(days, weekly).exceptAll(op.label_period(days, weekly)).isEmpty()
    got = {r.fecha_dia: r.periodo_covid for r in readings.collect()}
    assert len(got) == 1400
    for day, label in got.items():
        assert label == next((f"w{i}" for i, e in enumerate(ends) if day <= e), "later")
