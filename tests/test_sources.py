"""Tables written and read back, and the whole job against pandas."""

import os
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from flowmetrics import DEFAULT_CALENDAR as CALENDAR
from flowmetrics import Names, PeriodCalendar, ReadingColumns, fixed
from flowmetrics import operators as op
from flowmetrics.__main__ import main
from flowmetrics.plans import run_report
from flowmetrics.schema import result_schemas
from flowmetrics.sources import (
    load_tables,
    read_delimited,
    read_parquet,
    reload_table,
    scratch_folder,
    scratch_path,
    union_parts,
    write_clean_readings,
    write_table,
    written,
)
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F


def test_round_trip(spark, tmp_path):
    schema = result_schemas()[fixed.MONTHLY_TABLE]
    rows = [(2020, 1, 1.25), (2020, 2, None), (2020, 3, float("nan"))]
    df = spark.createDataFrame(rows, schema)
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        write_table(df, path, fmt)
        back = reload_table(spark, path, schema, fmt)
        assert back.schema == schema
        assert sorted(tuple(r) for r in back.collect()) == [
            (2020, 1, 1.25),
            (2020, 2, None),
            (2020, 3, None),
        ]
    write_table(df.limit(1), str(tmp_path / "csv"), "csv")
    assert reload_table(spark, str(tmp_path / "csv"), schema).count() == 1
    inferred = reload_table(spark, str(tmp_path / "csv"))
    assert inferred.columns == schema.names
    with pytest.raises(ValueError, match="format"):
        write_table(df, str(tmp_path / "x"), "xlsx")


def test_directory_without_tables_is_an_error(spark, tmp_path):
    schema = result_schemas()[fixed.MONTHLY_TABLE]
    (tmp_path / "readme.txt").write_text("no table")
    with pytest.raises(FileNotFoundError, match="no csv files"):
        reload_table(spark, str(tmp_path), schema)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        reload_table(spark, str(tmp_path / "absent"), schema)


def test_only_table_files_are_read(spark, tmp_path):
    schema = result_schemas()[fixed.MONTHLY_TABLE]
    (tmp_path / "a.csv").write_text("year,month,intensidad_media\n2020,1,5.0\n")
    (tmp_path / "b.csv").write_text("year,month,intensidad_media\n2020,2,6.0\n")
    (tmp_path / "notes.txt").write_text("x\n")
    assert reload_table(spark, str(tmp_path), schema).count() == 2


def test_drifted_header_fails_unless_accepted(spark, tmp_path):
    schema = result_schemas()[fixed.MONTHLY_TABLE]
    (tmp_path / "a.csv").write_text("Anio,Mes,IntensidadMedia\n2020,1,5.0\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        reload_table(spark, str(tmp_path), schema).collect()
    accepted = reload_table(spark, str(tmp_path), schema, check_header=False)
    assert [tuple(r) for r in accepted.collect()] == [(2020, 1, 5.0)]


def test_union_parts_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2.5, 2)], "v double, k int")
    out = union_parts([a, b])
    assert out.columns == ["k", "s", "v"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", None), (2, None, 2.5)]
    with pytest.raises(ValueError):
        union_parts([])


def test_scratch_lies_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(shared) and b.startswith(shared)
    with scratch_folder(spark, "t") as path:
        df = written(spark.range(3), f"{path}/ids")
        assert sorted(r.id for r in df.collect()) == [0, 1, 2]
        assert all(shared in f for f in df.inputFiles())
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        conf = {}
        sparkContext = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Cluster, "t")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Readings of four sensors at odd times over five years, some of them unusable."""
    rng = np.random.default_rng(7)
    n = 20_000
    seconds = rng.integers(0, 5 * 365 * 86_400, n)
    df = pd.DataFrame(
        {
            "id": rng.integers(1, 5, n),
            "fecha": (pd.Timestamp("2018-06-01") + pd.to_timedelta(seconds, "s")).strftime(
                "%Y-%m-%d %H:%M:%S"
            ),
            "tipo_elem": "URB",
            "intensidad": rng.integers(0, 900, n).astype(object),
            "ocupacion": 1,
            "carga": 2,
            "vmed": 3.5,
            "error": rng.choice(["N", "N", "N", "S", ""], n),
            "periodo_integracion": 15,
        }
    )
    df.loc[df.index % 97 == 0, "intensidad"] = ""
    df.loc[df.index % 101 == 0, "fecha"] = "broken"
    root = tmp_path_factory.mktemp("job")
    for i, part in enumerate(np.array_split(np.arange(n), 3)):
        folder = root / "raw" / f"set{i}"
        folder.mkdir(parents=True)
        df.iloc[part].to_csv(folder / "readings.csv", sep=";", index=False)
    return root, df


def expected_tables(df):
    """The same tables by pandas, from their description."""
    df = df[(df["error"] == "N") & (df["intensidad"] != "")].copy()
    df["ts"] = pd.to_datetime(df["fecha"], errors="coerce")
    df = df[df["ts"].notna() & df["ts"].dt.year.between(2019, 2022)]
    df["v"] = df["intensidad"].astype(float)
    day = df["ts"].dt.strftime("%Y-%m-%d")
    ends = [d for _, d in fixed.CLOSED_PERIODS]
    df["p"] = [CALENDAR.labels[sum(d > e for e in ends)] for d in day]
    df["y"], df["m"], df["h"], df["d"] = df.ts.dt.year, df.ts.dt.month, df.ts.dt.hour, day
    summary = {
        p: (g.mean(), sorted(g)[max(1, int(np.ceil(len(g) / 2))) - 1])
        for p, g in df.groupby("p")["v"]
    }
    return {
        fixed.SUMMARY_TABLE: summary,
        fixed.MONTHLY_TABLE: df.groupby(["y", "m"])["v"].mean().to_dict(),
        fixed.HOURLY_TABLE: df.groupby(["p", "h"])["v"].mean().to_dict(),
        fixed.DAILY_TABLE: df.groupby("d")["v"].mean().to_dict(),
    }


@pytest.fixture(scope="module", params=["csv", "parquet"])
def job(spark, raw, request):
    root, df = raw
    out = str(root / f"out-{request.param}")
    readings = read_delimited(spark, f"{root}/raw/*/*.csv")
    paths = run_report(readings, out, fmt=request.param, stage=request.param == "csv")
    scratch = f"{spark.conf.get('spark.checkpoint.dir')}/flowmetrics"
    assert not [d for d in os.listdir(scratch) if d.startswith("job-")]
    return out, paths, request.param, expected_tables(df)


def test_job_writes_the_first_tier(spark, job):
    out, _, fmt, want = job
    tables = load_tables(spark, out, fmt)
    summary = tables[fixed.SUMMARY_TABLE].collect()
    medians = {p: m for p, (_, m) in want[fixed.SUMMARY_TABLE].items()}
    assert {r[0]: r[2] for r in summary} == medians
    for r in summary:
        assert r[1] == pytest.approx(want[fixed.SUMMARY_TABLE][r[0]][0])
    for name in (fixed.MONTHLY_TABLE, fixed.HOURLY_TABLE):
        assert {tuple(r[:-1]): r[-1] for r in tables[name].collect()} == pytest.approx(want[name])
    daily = {str(r[0]): r[1] for r in tables[fixed.DAILY_TABLE].collect()}
    assert daily == pytest.approx(want[fixed.DAILY_TABLE])


def test_job_writes_the_report(spark, job):
    _, paths, fmt, want = job
    report = {
        name: reload_table(spark, path, fmt=fmt).collect() for name, path in paths["report"].items()
    }
    assert len(report) == 9
    monthly = pd.Series(want[fixed.MONTHLY_TABLE]).round(2)
    annual = monthly.groupby(level=0).mean()
    rows = {r[0]: r for r in report[fixed.REPORT_ANNUAL]}
    for year, mean in annual.items():
        assert rows[year][1] == pytest.approx(mean)
    changes = (annual.pct_change() * 100).round(2).iloc[1:]
    assert [rows[y][2] for y in changes.index] == pytest.approx(list(changes), abs=0.011)

    daily = pd.Series(want[fixed.DAILY_TABLE]).round(2)
    by_value = daily.sort_index().sort_values(ascending=False, kind="stable")
    assert [r[1] for r in report[fixed.REPORT_TOP]] == pytest.approx(list(by_value[:10]), abs=0.011)
    lowest = daily.sort_index().sort_values(kind="stable")
    assert [r[1] for r in report[fixed.REPORT_BOTTOM]] == pytest.approx(
        list(lowest[:10]), abs=0.011
    )
    number = pd.to_datetime(daily.index).dayofweek
    kinds = np.where(number < 5, "Laborable", np.where(number == 5, "Sábado", "Domingo"))
    by_kind = daily.groupby(kinds).mean()
    got = {r[0]: r[1] for r in report[fixed.REPORT_DAY_TYPE]}
    assert got == pytest.approx(by_kind.to_dict(), abs=0.011)

    means = {p: round(m, 2) for p, (m, _) in want[fixed.SUMMARY_TABLE].items()}
    base = means[fixed.BASELINE_PERIOD]
    got = {r[0]: r[3] for r in report[fixed.REPORT_COMPARISON]}
    assert got == pytest.approx({p: (m - base) / base * 100 for p, m in means.items()}, abs=0.02)


def test_job_writes_the_figure_tables(spark, job):
    _, paths, fmt, want = job
    figures = {name: reload_table(spark, path, fmt=fmt) for name, path in paths["figures"].items()}
    assert len(figures) == 15
    assert figures["month_year"].count() == 12
    assert figures["hour_period"].columns == ["hour", *CALENDAR.labels]
    assert figures["daily_series"].count() == len(want[fixed.DAILY_TABLE])
    box = {r.periodo_covid: r for r in figures["raw_distribution"].collect()}
    daily = pd.Series(want[fixed.DAILY_TABLE])
    ends = [d for _, d in fixed.CLOSED_PERIODS]
    label = [CALENDAR.labels[sum(d > e for e in ends)] for d in daily.index]
    for p, values in daily.groupby(label):
        q1, q2, q3 = np.percentile(values, [25, 50, 75])
        assert (box[p].q1, box[p].median, box[p].q3) == pytest.approx((q1, q2, q3))
        near = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        assert (box[p].whisker_lo, box[p].whisker_hi) == pytest.approx((near.min(), near.max()))


def test_clean_readings_as_parquet(spark, raw, tmp_path):
    root, _ = raw
    clean = op.clean_readings(read_delimited(spark, f"{root}/raw/*/*.csv"))
    path = str(tmp_path / "clean")
    write_clean_readings(clean, path)
    back = read_parquet(spark, path).select("ts", "value")
    assert back.exceptAll(clean).count() == 0 and clean.exceptAll(back).count() == 0
    one = read_parquet(spark, path).where("year = 2020")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_command_line(spark, raw, tmp_path, capsys):
    root, _ = raw
    main([f"{root}/raw/*/*.csv", "--output", str(tmp_path / "out"), "--top", "3"])
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == 4 + 9 + 15
    top = reload_table(spark, str(tmp_path / "out/report" / fixed.REPORT_TOP), fmt="parquet")
    assert top.count() == 3


def test_job_with_other_names_columns_and_periods(spark, tmp_path):
    """Nothing depends on the default names; names with spaces work too."""
    names = Names(
        time="at",
        value="speed",
        year="yr",
        month="mo",
        hour="h r",
        day="the day",
        period="phase",
        mean="avg speed",
        median="mid speed",
        day_mean="day avg",
        annual_mean="year avg",
        annual_change="year change",
        day_type="kind",
        baseline_change="vs base",
    )
    calendar = PeriodCalendar.of([("before", "2024-02-29"), ("it's on", "2024-06-30")], "after")
    raw = spark.range(0, 366 * 24).select(
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:30:00' + make_interval(0, 0, 0, 0, id)").alias("t"),
        (F.col("id") % 7).alias("s"),
        F.lit("ok").alias("q"),
    )
    paths = run_report(
        raw,
        str(tmp_path / "out"),
        ReadingColumns("t", "s", "q"),
        (2024, 2024),
        "ok",
        calendar,
        n=3,
        baseline="before",
        names=names,
    )
    report = {
        name: reload_table(spark, path, fmt="parquet") for name, path in paths["report"].items()
    }
    comparison = report[fixed.REPORT_COMPARISON]
    assert comparison.columns == ["phase", "avg speed", "mid speed", "vs base"]
    assert {r.phase: r["vs base"] for r in comparison.collect()}["before"] == 0.0
    assert report[fixed.REPORT_ANNUAL].columns == ["yr", "year avg", "year change"]
    assert report[fixed.REPORT_TOP].count() == 3
    hours = reload_table(spark, paths["figures"]["hour_period"], fmt="parquet")
    assert hours.columns == ["h r", "before", "it's on", "after"]
    assert hours.count() == 24
    for median in ("approx", "exact"):
        readings = op.prepare_readings(
            raw, ReadingColumns("t", "s", "q"), (2024, 2024), "ok", calendar, names
        )
        rows = op.period_summary(readings, median, names=names).collect()
        assert {r["mid speed"] for r in rows} == {3.0}
