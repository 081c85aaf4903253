"""Derived tables against published values, and their edge cases."""

import pytest
from pyspark.errors import AnalysisException, PySparkException

from flowmetrics import DEFAULT_CALENDAR as CALENDAR
from flowmetrics import PeriodCalendar
from flowmetrics import operators as op
from flowmetrics.operators import charts
from tests import golden


@pytest.fixture(scope="module")
def monthly(spark):
    rows = [
        (year, month, mean)
        for month, means in golden.matrix(golden.MONTH_YEAR).items()
        for year, mean in zip(range(2019, 2023), means)
        if mean is not None
    ]
    assert len(rows) == 46
    return spark.createDataFrame(rows, "year int, month int, intensidad_media double")


@pytest.fixture(scope="module")
def hourly(spark):
    rows = [
        (period, hour, mean)
        for hour, means in golden.matrix(golden.HOUR_PERIOD).items()
        for period, mean in zip(CALENDAR.labels, means)
    ]
    assert len(rows) == 120
    return spark.createDataFrame(rows, "periodo_covid string, hour int, intensidad_media double")


@pytest.fixture(scope="module")
def summary(spark):
    return spark.createDataFrame(
        golden.SUMMARY,
        "periodo_covid string, intensidad_media double, intensidad_mediana double",
    )


def daily_frame(spark, rows):
    df = spark.createDataFrame(rows, "d string, intensidad_media_dia double")
    return df.selectExpr("CAST(d AS DATE) AS fecha_dia", "intensidad_media_dia")


def test_annual_change(monthly):
    got = [tuple(r) for r in op.annual_change(monthly).collect()]
    assert [(y, round(m, 6), c) for y, m, c in got] == [row[:3] for row in golden.ANNUAL]


def test_annual_labels(monthly):
    rows = charts.annual_labels(op.annual_change(monthly)).collect()
    assert [r.label for r in rows] == [row[3] for row in golden.ANNUAL]


def test_annual_line(monthly):
    rows = charts.annual_line(monthly).collect()
    assert [r.label for r in rows] == ["425", "312", "362", "350"]


def test_annual_mean_rounds_the_months_first_or_not(spark):
    monthly = spark.createDataFrame(
        [(2019, 1, 1.004), (2019, 2, 2.004)], "year int, month int, intensidad_media double"
    )
    assert op.annual_mean(monthly).first()[1] == 1.5
    assert op.annual_mean(monthly, pre_round=None).first()[1] == pytest.approx(1.504)


def test_annual_change_bridges_a_gap_and_survives_zero(spark):
    monthly = spark.createDataFrame(
        [(2015, 1, 10.0), (2018, 1, 15.0), (2019, 1, 0.0), (2020, 1, 5.0)],
        "year int, month int, intensidad_media double",
    )
    changes = [r[2] for r in op.annual_change(monthly).collect()]
    assert changes == [None, 50.0, -100.0, None]


def test_baseline_comparison(summary):
    rows = op.baseline_comparison(summary).collect()
    assert [r.periodo_covid for r in rows] == sorted(golden.BASELINE_CHANGE)
    assert {r.periodo_covid: r.variacion_vs_PreCOVID_pct for r in rows} == golden.BASELINE_CHANGE


@pytest.mark.parametrize("baseline", ["not there", None])
def test_baseline_absent_gives_null(summary, baseline):
    rows = op.baseline_comparison(summary, baseline=baseline or "").collect()
    assert len(rows) == 5
    assert all(r.variacion_vs_PreCOVID_pct is None for r in rows)


def test_baseline_zero_gives_null(spark):
    summary = spark.createDataFrame(
        [("Pre-COVID", 0.0), ("Desescalada", 3.0)], "periodo_covid string, intensidad_media double"
    )
    rows = op.baseline_comparison(summary).collect()
    assert [r.variacion_vs_PreCOVID_pct for r in rows] == [None, None]


def test_month_year_matrix(monthly):
    want = {m: tuple(v) for m, v in golden.matrix(golden.MONTH_YEAR).items()}
    for years in (range(2019, 2023), None):
        df = op.pivot_month_year(monthly, years)
        assert df.columns == ["month", "2019", "2020", "2021", "2022"]
        rows = df.collect()
        assert [r[0] for r in rows] == list(range(1, 13))
        assert {r[0]: tuple(r[1:]) for r in rows} == want


def test_matrix_keeps_a_column_without_data(monthly):
    df = op.pivot_month_year(monthly, [2018, 2019])
    assert all(r["2018"] is None for r in df.collect())


def test_hour_period_matrix(hourly):
    df = op.pivot_hour_period(hourly)
    assert df.columns == ["hour", *CALENDAR.labels]
    want = {h: tuple(v) for h, v in golden.matrix(golden.HOUR_PERIOD).items()}
    assert {r[0]: tuple(r[1:]) for r in df.collect()} == want


def test_matrix_rejects_two_rows_for_one_cell(monthly):
    doubled = monthly.unionByName(monthly)
    with pytest.raises(PySparkException, match="duplicate matrix cell"):
        op.pivot_month_year(doubled, [2019]).collect()


def test_matrix_and_back(monthly):
    wide = op.pivot_month_year(monthly, range(2019, 2023))
    long = wide.unpivot("month", wide.columns[1:], "year", "intensidad_media")
    back = long.where("intensidad_media IS NOT NULL").selectExpr(
        "CAST(year AS INT) year", "month", "intensidad_media"
    )
    assert back.exceptAll(monthly).count() == 0
    assert monthly.exceptAll(back).count() == 0


def test_day_types_in_logical_order(spark):
    daily = daily_frame(
        spark,
        [("2020-03-15", 5.0), ("2020-03-14", 7.0), ("2020-03-16", 1.0), ("2020-03-17", 2.0)],
    )
    rows = [tuple(r) for r in op.day_type_mean(daily).collect()]
    assert rows == [("Laborable", 1.5), ("Sábado", 7.0), ("Domingo", 5.0)]
    bars = charts.day_type_bars(op.day_type_mean(daily)).collect()
    assert [(r.ordinal, r.tipo_dia) for r in bars] == [
        (1, "Laborable"),
        (2, "Sábado"),
        (3, "Domingo"),
    ]


def test_top_and_bottom_days_break_ties_by_date(spark):
    daily = daily_frame(
        spark,
        [
            ("2020-01-03", 5.0),
            ("2020-01-01", 5.0),
            ("2020-01-02", 9.0),
            ("2020-01-04", 1.0),
            ("2020-01-05", None),
        ],
    )
    assert [str(r[0]) for r in op.top_days(daily, 2).collect()] == ["2020-01-02", "2020-01-01"]
    assert [str(r[0]) for r in op.bottom_days(daily, 2).collect()] == ["2020-01-04", "2020-01-01"]
    assert [r[1] for r in op.top_days(daily, 9).collect()] == [9.0, 5.0, 5.0, 1.0, None]
    assert [r[1] for r in op.bottom_days(daily, 9).collect()] == [1.0, 5.0, 5.0, 9.0, None]
    bars = [tuple(r) for r in charts.top_day_bars(op.top_days(daily, 3)).collect()]
    assert bars == [("2020-01-03", 5.0), ("2020-01-01", 5.0), ("2020-01-02", 9.0)]


def test_distribution_has_every_period(spark):
    days = [("2019-01-01", 1.0), ("2019-01-02", 2.0), ("2019-01-03", 3.0), ("2019-01-04", 4.0)]
    daily = daily_frame(spark, [*days, ("2019-01-05", 100.0), ("2022-01-01", 7.0)])
    rows = op.distribution_by_period(daily).collect()
    assert [r.periodo_covid for r in rows] == CALENDAR.labels
    first, last = rows[0], rows[-1]
    assert (first.q1, first.median, first.q3, first.n) == (2.0, 3.0, 4.0, 5)
    assert (first.whisker_lo, first.whisker_hi) == (1.0, 4.0)
    assert (last.q1, last.whisker_lo, last.whisker_hi, last.n) == (7.0, 7.0, 7.0, 1)
    for r in rows[1:-1]:
        assert (r.q1, r.median, r.q3, r.whisker_lo, r.whisker_hi, r.n) == (None,) * 5 + (0,)


def test_whisker_stays_at_the_box_when_no_day_is_nearer(spark):
    """One low day pulls the quartile below every day within reach of the box."""
    values = [0.0, 10.0, 10.0, 10.0]
    daily = daily_frame(spark, [(f"2019-01-0{i}", v) for i, v in enumerate(values, start=1)])
    r = op.distribution_by_period(daily).first()
    assert (r.q1, r.q3) == (7.5, 10.0)
    assert (r.whisker_lo, r.whisker_hi) == (7.5, 10.0)


def test_logical_order_puts_unknown_labels_last(spark):
    df = spark.createDataFrame(
        [("zz", 1), ("Desescalada", 2), ("Pre-COVID", 3), (None, 4)], "periodo_covid string, x int"
    )
    rows = op.logical_order(df, then=["periodo_covid"]).collect()
    assert [r.ordinal for r in rows] == [1, 3, None, None]


def test_present_periods_and_fallback(summary):
    known = PeriodCalendar.of([("Pre-COVID", "2020-01-01")], "Desescalada")
    rows = op.present_periods(summary, known).collect()
    assert [r.periodo_covid for r in rows] == ["Pre-COVID", "Desescalada"]
    other = PeriodCalendar.of([("a", "2020-01-01")], "b")
    rows = op.present_periods(summary, other).collect()
    assert [r.periodo_covid for r in rows] == sorted(p for p, *_ in golden.SUMMARY)


def test_period_bars(summary):
    rows = charts.period_bars(summary).collect()
    assert [r.periodo_covid for r in rows] == CALENDAR.labels
    means = {p: m for p, m, _ in golden.SUMMARY}
    assert [r.label for r in rows] == [f"{means[p]:.0f}" for p in CALENDAR.labels]


def test_lines(monthly, hourly):
    lines = charts.monthly_lines(monthly).collect()
    assert [(r.series, r.month) for r in lines[:2]] == [("2019", 3), ("2019", 4)]
    lines = charts.hourly_lines(hourly).collect()
    assert [r.hour for r in lines[:24]] == list(range(24))
    assert len({r.series for r in lines[:24]}) == 1


@pytest.mark.parametrize(
    "run",
    [
        lambda df: op.annual_mean(df),
        lambda df: op.day_type_mean(df),
        lambda df: op.top_days(df),
        lambda df: op.baseline_comparison(df),
        lambda df: op.pivot_hour_period(df),
        lambda df: op.distribution_by_period(df),
        lambda df: op.logical_order(df),
        lambda df: charts.daily_series(df),
    ],
)
def test_a_missing_column_fails_before_any_job(spark, run):
    with pytest.raises(AnalysisException):
        run(spark.createDataFrame([(1,)], "PeriodoCovid int"))
