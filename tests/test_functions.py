"""Column expressions against Python's own arithmetic, and calendar properties."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowmetrics import DEFAULT_CALENDAR, PeriodCalendar
from flowmetrics import functions as fx
from flowmetrics import operators as op
from pyspark.sql import functions as F

QUIET = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def values(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "x double")


def test_signed_percent_label_formats_like_the_stored_double(spark):
    xs = [round(i * 0.05, 2) for i in range(-420, 421)] + [15.95, -26.53, 0.25, 1e6 + 0.05, 99.95]
    labels = [r[0] for r in values(spark, xs).select(fx.signed_percent_label(F.col("x"))).collect()]
    assert labels == [f"{x:+.1f}%" for x in xs]
    assert values(spark, [None]).select(fx.signed_percent_label(F.col("x"))).first()[0] is None


@QUIET
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=50))
def test_signed_percent_label_on_any_value(spark, xs):
    labels = [r[0] for r in values(spark, xs).select(fx.signed_percent_label(F.col("x"))).collect()]
    want = [f"{x:+.1f}%" for x in xs]
    # A negative zero has no sign here.
    assert labels == [w if x or str(x) != "-0.0" else "+0.0%" for w, x in zip(want, xs)]


def test_whole_number_label_takes_ties_to_even(spark):
    xs = [0.5, 1.5, 2.5, -2.5, 424.97, 349.5, 1e12 + 0.5]
    labels = [r[0] for r in values(spark, xs).select(fx.whole_number_label(F.col("x"))).collect()]
    assert labels == [f"{x:.0f}" for x in xs]


def test_round_stable(spark):
    xs = [1.005, 2.675, -1.005, 1e15 + 0.5, 1e300, float("inf"), None, 0.1 + 0.2]
    got = [r[0] for r in values(spark, xs).select(fx.round_stable(F.col("x"), 2)).collect()]
    assert got == [1.01, 2.68, -1.01, 1e15 + 0.5, 1e300, float("inf"), None, 0.3]


def test_round_stable_forgives_the_order_of_a_sum(spark):
    up = sum([0.1, 0.2, 0.3, 1.41]) / 4
    down = sum([1.41, 0.3, 0.2, 0.1]) / 4
    got = values(spark, [up, down]).select(fx.round_stable(F.col("x"), 4)).distinct().count()
    assert got == 1


def test_pct_change(spark):
    pairs = [(3.0, 2.0), (3.0, 0.0), (None, 2.0), (2.0, None)]
    df = spark.createDataFrame(pairs, "a double, b double")
    got = [r[0] for r in df.select(fx.pct_change(F.col("a"), F.col("b"))).collect()]
    assert got == [50.0, None, None, None]


def test_to_number(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("",), ("NaN",), (None,), (" 2 ",)], "x string")
    got = [r[0] for r in df.select(fx.to_number(F.col("x"))).collect()]
    assert got == [1.5, None, None, None, None, 2.0]


@pytest.mark.parametrize(
    "text",
    [
        "2020-1-01 00:00:00",
        "2020-01-01T00:00:00",
        "2020-01-01",
        "2020-01-01 24:00:00",
        "2020-13-01 00:00:00",
        "2020-01-01 00:00:00.5",
        " 2020-01-01 00:00:00",
        "2020-01-01 00:00:00+01:00",
    ],
)
def test_text_off_the_pattern_is_null(spark, text):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(fx.parse_timestamp(F.col("x"))).first()[0] is None


def test_labels_may_hold_quotes_and_backslashes(spark):
    odd = PeriodCalendar.of([("it's \\ \"x\"", "2020-01-01")], "o'rest\\")
    df = spark.sql("SELECT explode(array(DATE'2020-01-01', DATE'2020-01-02')) AS fecha_dia")
    for label in (op.label_period, op.label_period_by_join):
        assert sorted(r.periodo_covid for r in label(df, odd).collect()) == sorted(odd.labels)


DAYS = st.dates(date(1990, 1, 1), date(2030, 12, 31))


@QUIET
@given(st.sets(DAYS, min_size=1, max_size=6), st.lists(DAYS, min_size=1, max_size=40))
def test_every_day_gets_one_label_whichever_way(spark, ends, days):
    ends = sorted(ends)
    calendar = PeriodCalendar.of([(f"p{i}", e) for i, e in enumerate(ends)], "rest")
    days = sorted({*days, *ends, *(e + timedelta(days=1) for e in ends)})
    df = spark.createDataFrame([(d,) for d in days], "fecha_dia date")
    want = {d: next((f"p{i}" for i, e in enumerate(ends) if d <= e), "rest") for d in days}
    at_noon = "CAST(fecha_dia AS TIMESTAMP_NTZ) + INTERVAL '12' HOUR"
    for labelled in (
        op.label_period(df, calendar),
        op.label_period_by_join(df, calendar),
        df.withColumn("periodo_covid", calendar.label_at(at_noon)),
    ):
        rows = labelled.select("fecha_dia", "periodo_covid").collect()
        assert dict(tuple(r) for r in rows) == want


@QUIET
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 9)), min_size=1, max_size=60))
def test_top_and_the_rest_are_all(spark, rows):
    daily = {date(2020, 1, 1) + timedelta(days=d): float(v) for d, v in rows}
    df = spark.createDataFrame(list(daily.items()), "fecha_dia date, intensidad_media_dia double")
    n = 5
    top = [tuple(r) for r in op.top_days(df, n).collect()]
    bottom = [tuple(r) for r in op.bottom_days(df, n).collect()]
    assert top == sorted(daily.items(), key=lambda r: (-r[1], r[0]))[:n]
    assert bottom == sorted(daily.items(), key=lambda r: (r[1], r[0]))[:n]


def test_rollup_gives_the_direct_means(spark):
    df = spark.range(5000).select(
        F.expr("TIMESTAMP_NTZ'2019-12-30 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 37)").alias(
            "fecha"
        ),
        (F.col("id") % 97).cast("double").alias("intensidad"),
        F.lit("N").alias("error"),
    )
    readings = op.prepare_readings(df)
    tables = op.means_from_rollup(op.day_hour_rollup(readings))
    direct = {
        "intensidad_mensual": op.monthly_mean(readings),
        "curva_horaria": op.hourly_curve(readings),
        "intensidad_diaria": op.daily_mean(readings),
    }
    for name, want in direct.items():
        got, want = tables[name].collect(), want.collect()
        assert [r[:-1] for r in got] == [r[:-1] for r in want]
        assert [r[-1] for r in got] == pytest.approx([r[-1] for r in want])
    grains = op.four_grains(op.day_hour_rollup(readings)).collect()
    assert len(grains) == sum(len(t.collect()) for t in tables.values()) + len(
        {r[0] for r in direct["curva_horaria"].collect()}
    )
    assert DEFAULT_CALENDAR.labels[0] in {g.periodo_covid for g in grains}
