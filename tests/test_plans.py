"""What the plans must and must not hold, whatever the size of the data."""

import pytest

import __spark_entry__ as contract
from flowmetrics import operators as op
from flowmetrics.operators import aggregate, compare, median, reshape
from flowmetrics.plans import report
from flowmetrics.sources import scratch, write_clean_readings

SF_DIR = "/root/testdata/sf0.01"
WRITING = {
    "scan_delimited", "reload_result_table", "union_parts", "report_basic", "report_full",
    "report_full_events", "clean_readings_text", "filter_year_partitions", "scan_inferred", "run_job",
}


def plan(df, executed=False):
    if executed:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[0]


@pytest.fixture(scope="module")
def orders(spark):
    return contract._orders(spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(set(contract.own_queries()) - WRITING))
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for bad in ("EvalPython", "InPandas", "Cartesian", "NestedLoop", "ExistingRDD"):
        assert bad not in text


def test_scan_is_pruned_and_filtered(spark, orders):
    execution = op.monthly_mean(orders)._jdf.queryExecution()
    explain = spark.sparkContext._jvm.PythonSQLUtils.explainString
    text = explain(execution, "formatted")
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderdate" in text
    assert "EqualTo(o_orderstatus,O)" in text
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)" in text
    assert "LessThan(o_orderdate,2002-01-01T00:00)" in text


def test_aggregates_combine_before_the_shuffle(orders):
    for df in (op.monthly_mean(orders), op.daily_mean(orders), op.day_hour_rollup(orders)):
        text = plan(df)
        assert "partial_" in text
        assert text.count("Exchange hashpartitioning") == 1
        assert text.count("FileScan") == 1


def test_four_grains_scan_once_and_expand_only_the_rollup(orders):
    text = plan(op.four_grains(op.day_hour_rollup(orders), contract.ORDER_PERIODS))
    assert text.count("FileScan") == 1
    assert text.index("Expand") < text.index("partial_sum(value")


def test_top_days_do_not_sort_everything(orders):
    text = plan(op.top_days(op.daily_mean(orders, ordered=False)))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_long_calendars_probe_one_hash_table(spark):
    days = contract._order_days(spark, SF_DIR)
    text = plan(op.label_period_by_join(days, contract.ORDER_PERIODS))
    assert "BroadcastHashJoin" in text


@pytest.fixture
def written_plans(monkeypatch):
    """The plans of the tables that operators write on the way."""
    plans = []

    def recorded(df, path):
        plans.append(plan(df))
        return scratch.written(df, path)

    for module in (aggregate, compare, median, reshape, report):
        monkeypatch.setattr(module, "written", recorded)
    return plans


def scans(text):
    """Scans of the tables given, not of tables written on the way."""
    return sum("FileScan" in line and "testdata" in line for line in text.splitlines())


@pytest.fixture
def wide_slots(monkeypatch):
    """A first count so coarse that a second scan is needed on small tables, too."""
    monkeypatch.setattr(median, "LOG_SLOTS", 4)


def test_exact_median_gathers_no_group(orders, written_plans, wide_slots):
    text = plan(op.period_summary(orders, "exact"), executed=True)
    first = written_plans[0]
    assert "percentile" not in text + first
    # Readings are only ever shuffled by (period, slot) or (period, value).
    assert scans(first) == 1 and scans(text) == 1
    assert "hashpartitioning(g#" in first and ", slot#" in first
    # The ranges of one period each are broadcast for their size, not by a hint.
    assert "BroadcastHashJoin" in text and "hint" not in text.lower()


def test_job_scans_the_readings_twice(orders, written_plans, wide_slots):
    tables = report.first_tier(orders, contract.ORDER_PERIODS, "exact")
    texts = [*written_plans, *[plan(t) for t in tables.values()]]
    assert sum(map(scans, texts)) == 2
    for t in tables.values():
        assert "rangepartitioning" not in plan(t)


@pytest.mark.parametrize("kind", ["approx", "exact"])
def test_first_tier_tables_are_sorted_without_sampling(orders, kind):
    tables = [
        op.period_summary(orders, kind), op.monthly_mean(orders), op.hourly_curve(orders),
        op.daily_mean(orders), *report.first_tier(orders, contract.ORDER_PERIODS, kind).values(),
    ]
    for df in tables:
        assert "rangepartitioning" not in plan(df)
        keys = [c for c in df.columns if not c.startswith("intensidad")]
        rows = [tuple(r) for r in df.select(*keys).collect()]
        assert rows == sorted(rows) and len(rows) > 1


@pytest.mark.parametrize("name", ["present_periods", "present_periods_fallback", "baseline_comparison", "event_change"])
def test_no_window_over_everything(spark, name):
    for line in plan(contract.queries()[name](spark, SF_DIR)).splitlines():
        assert "Window" not in line or "_range" in line


def test_staged_readings_have_files_of_even_size(spark, tmp_path):
    """Two hundred tiny inputs: few files, no reading lost."""
    rows = spark.range(20_000).selectExpr(
        "TIMESTAMP_NTZ'2019-06-01 00:00:00' + make_interval(0, 0, 0, 0, id % 9000) AS fecha",
        "cast(id AS double) AS intensidad", "'N' AS error",
    )
    rows.repartition(200).write.parquet(str(tmp_path / "raw"))
    clean = op.clean_readings(spark.read.parquet(str(tmp_path / "raw")), years=None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        write_clean_readings(clean, str(tmp_path / "staged"), partition_by_year=False)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(list((tmp_path / "staged").glob("*.parquet"))) <= 8
    assert spark.read.parquet(str(tmp_path / "staged")).count() == 20_000


def test_approximate_median_merges_sketches_of_hours(orders):
    text = plan(op.period_summary(orders, "approx"))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2


def test_long_calendars_shuffle_nothing(spark):
    days = contract._order_days(spark, SF_DIR)
    for label in (op.label_period, op.label_period_by_join):
        df = label(days, contract.WEEKS)
        assert df.columns == ["o_orderkey", "fecha_dia", "periodo_covid"]
        assert "Exchange hashpartitioning" not in plan(df)
    short = op.label_period(days, contract.ORDER_PERIODS)
    assert short.columns == op.label_period(days, contract.WEEKS).columns


def test_staged_years_are_pruned(spark):
    df = contract.filter_year_partitions(spark, SF_DIR)
    scan = next(x for x in plan(df).splitlines() if "FileScan" in x)
    assert "PartitionFilters: []" not in scan and "1996" in scan.split("PartitionFilters")[1]


def test_many_parts_make_a_shallow_union(spark):
    from flowmetrics.sources import union_parts

    parts = [spark.range(1) for _ in range(64)]
    assert union_parts(parts)._jdf.queryExecution().analyzed().toString().count("\n") < 400
    assert union_parts(parts).count() == 64


# The exact median scans twice, whiskers of readings take another look, and so does the check
# whether the sketch's median is near the middle.
SCANS = {
    "median_exact": 2, "median_approx": 2, "median_approx_fine": 2, "period_summary": 2,
    "baseline_comparison": 2, "baseline_missing": 2, "distribution_of_readings": 3, "ordered_summary": 2,
}


@pytest.mark.parametrize("name", sorted(set(contract.own_queries()) - WRITING))
def test_tables_are_scanned_once(spark, written_plans, wide_slots, name):
    text = plan(contract.queries()[name](spark, SF_DIR), executed=True)
    assert sum(map(scans, [text, *written_plans])) == SCANS.get(name, 1)


def test_annual_table_is_aggregated_before_the_single_partition(orders):
    text = plan(op.annual_change(op.monthly_mean(orders, ordered=False)))
    window, single = text.index("Window"), text.index("SinglePartition")
    assert window < single < text.index("HashAggregate")
    assert "rangepartitioning" not in text
