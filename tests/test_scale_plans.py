"""Plans that matter at scale: filters that reach the scan, hot keys, frames,
expansions, and the order of ordered reports."""

import contextlib
import io
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskspark.functions.scalar import headcount_bucket
from riskspark.plans import QUERIES
from riskspark.plans.books import dormancy_book
from riskspark.sources.catalog import LOGICAL_TABLES, Tables
from riskspark.sources.driver_adapter import driver_tables

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def logical(spark):
    """The logical tables as Parquet, so that scans show what reaches them."""
    root = tempfile.mkdtemp(prefix="rs-logical-", dir="/tmp")
    t = driver_tables(spark, SF_SMALL)
    for name in LOGICAL_TABLES:
        t[name].write.parquet(f"{root}/{name}")
    return {name: f"{root}/{name}" for name in LOGICAL_TABLES}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_window_and_cutoff_filters_reach_the_scan(spark, logical):
    t, p = Tables.from_parquet(spark, logical), E.PARAMS
    plan = _plan(QUERIES["tagged_event_extract"](t, p))
    pushed = [x for x in plan.splitlines() if "PushedFilters" in x]
    assert any(f"GreaterThanOrEqual(created_at,{p.fp_window_start}T00:00" in x for x in pushed)
    assert any(f"Or(LessThan(created_at,{p.fp_window_start}T00:00" in x for x in pushed)
    assert any("LessThan(created_us," in x for x in _plan(QUERIES["movement_latest"](t, p)).splitlines())


HOT = 40


def _skewed(spark, logical, **frames):
    t = Tables.from_parquet(spark, logical)
    root = tempfile.mkdtemp(prefix="rs-hot-", dir="/tmp")
    out = {}
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return t.with_tables(**out)


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_unit_of_the_mart_is_split(spark, logical, no_broadcast):
    n, p = 300_000, E.PARAMS
    t = Tables.from_parquet(spark, logical)
    ids = (t["dim_user"].join(t["enrolled_merchant"], "merchant_token").select("user_token")
           .orderBy("user_token").limit(HOT).toPandas()["user_token"].tolist())
    unit = F.when(F.col("id") % 10 != 0, F.lit(ids[0])).otherwise(
        F.element_at(F.lit(ids), (F.col("id") % HOT + 1).cast("int")))
    evaluations = spark.range(0, n, 1, 8).select(
        F.col("id").alias("payment_token"), unit.alias("unit_token"), F.col("id").alias("bill_token"),
        F.lit("HIGH").alias("risk_level"), F.lit("2001-01-01").cast("timestamp_ntz").alias("created_at"))
    t = _skewed(spark, logical, risk_evaluation=evaluations)
    df = QUERIES["payment_risk_mart"](t, p)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_user_is_a_few_rows_before_the_joins(spark, logical, no_broadcast):
    """Nine in ten log entries, and chargebacks, are one user's: the rows that
    meet the other side are bounded by days, not by entries."""
    p, n = E.PARAMS, 200_000
    user = F.when(F.col("id") % 10 != 0, F.lit(4)).otherwise(F.col("id") % 97)
    at = F.lit("2001-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), (F.col("id") % 240).cast("int"), F.lit(0), (F.col("id") % 60).cast("decimal(18,6)"))
    log = spark.range(0, n, 1, 8).select(
        user.alias("target_token"), at.alias("created_at"),
        F.lit("x").alias("comment"), F.lit(p.suspect_action).alias("action_name"))
    cb = spark.range(0, n, 1, 8).select(
        F.col("id").alias("payment_token"), user.alias("user_token"), at.alias("payment_created_at"),
        F.to_date(at).alias("chargeback_date"), F.lit("USD").alias("currency_code"),
        F.lit(100).cast("bigint").alias("chargeback_cents"), F.lit(10).cast("bigint").alias("loss_cents"),
        F.lit("fraud").alias("type"), F.lit("open").alias("status"))
    t = _skewed(spark, logical, audit_log=log, chargeback=cb)
    for name, bound in (("detector_precision_month", 2 * 10 * 97), ("detector_precision_year", 2 * 10 * 97),
                        ("chargebacks_fx_daily", 10 * 97), ("reactivation_value", 10 * 97)):
        df = QUERIES[name](t, p)
        df.collect()
        assert _most_join_rows(df._jdf.queryExecution().executedPlan()) <= max(bound, 30_000), name


def _most_join_rows(plan) -> int:
    """The most rows that any join of an executed plan puts out."""
    most, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
            continue
        if "Join" in name and node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_reactivation_frames_and_seller_counts(spark):
    t, p = driver_tables(spark, SF_SMALL), E.PARAMS
    plan = _plan(QUERIES["reactivation_value"](t, p))
    assert "Expand" not in plan
    # a frame that ends with the partition is only allowed over all of it (one pass)
    assert "unboundedfollowing" not in plan.lower().replace("unboundedpreceding$(), unboundedfollowing", "")
    assert "Expand" not in _plan(QUERIES["dispute_sellers"](t, p))


ORDER = {"detector_recall_month": ("ato_month", True), "detector_recall_year": ("ato_year", True),
         "segment_moved": ("last_money_movement_dormancy_category", False),
         "dispute_rate_count": ("transaction_month", False), "dispute_rate_amount": ("transaction_month", False),
         "dispute_sellers": ("transaction_month", False), "high_dispute_share": ("transaction_month", False),
         "dispute_loss_split": ("transaction_month", False), "loss_bps_month": ("transaction_month", False)}


@pytest.mark.parametrize("name", sorted(ORDER))
def test_ordered_reports_are_ordered(spark, name):
    key, descending = ORDER[name]
    values = [r[key] for r in E.queries()[name](spark, SF_SMALL).collect()]
    keyed = [(v is not None, v) for v in values]
    assert keyed == sorted(keyed, reverse=descending) and len(values) > 1


def test_headcount_zero_label(spark):
    df = spark.createDataFrame([(0,), (1,), (3,)], "n int")
    plain = [r[0] for r in df.select(headcount_bucket("n")).collect()]
    own = [r[0] for r in df.select(headcount_bucket("n", "0. none")).collect()]
    assert plain[0] == plain[2] and own == ["0. none", *plain[1:]]


def test_calendar_covers_every_week_of_the_data(spark):
    weeks = [r.week_start_date for r in E.queries()["paid_adoption_week"](spark, SF_SMALL)
             .select("week_start_date").distinct().orderBy("week_start_date").collect()]
    assert str(weeks[0]) == "1998-05-25" and str(weeks[-1]) == "2001-12-31" and len(weeks) == 189


def _exchanged_stages(plan, found=None, below=False) -> list[str]:
    """The staged tables of an initial plan that a shuffle or a sort of all
    rows deals out anew before the next join, grouping or window."""
    found = [] if found is None else found
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _exchanged_stages(plan.initialPlan(), found, below)
    if "Exchange" in name:
        below = True
    elif any(x in name for x in ("Join", "Aggregate", "Window")):
        below = False
    if below and "stage_" in plan.simpleString(1000) and "Scan" in name:
        found.append(plan.simpleString(1000))
    for i in range(plan.children().size()):
        _exchanged_stages(plan.children().apply(i), found, below)
    return found


def test_bucketed_stages_are_not_shuffled(spark, no_broadcast):
    """Joins and groupings by unit read the dormancy book's stages as they lie."""
    t, p = driver_tables(spark, SF_SMALL, fresh=True), E.PARAMS
    reports = dormancy_book(t, p, tempfile.mkdtemp(prefix="rs-stage-", dir="/tmp"))
    movement = reports["last_money_movement"]._jdf.queryExecution().executedPlan()
    # both sides are staged by the join's key: nothing is shuffled
    assert "Exchange" not in movement.toString() and "SortMergeJoin" in movement.toString()
    history = reports["gap_history"]._jdf.queryExecution().executedPlan()
    assert "Exchange" in history.toString() and not _exchanged_stages(history)
    by_unit = t.derived("payment_gaps", p, None).groupBy("unit_token").count()
    assert "Exchange" not in by_unit._jdf.queryExecution().executedPlan().toString()
    # the walk above does see a stage that is dealt out anew
    other = t.derived("payment_gaps", p, None).repartition("payment_date")
    assert _exchanged_stages(other._jdf.queryExecution().executedPlan())
    names = [x.name for x in spark.catalog.listTables() if x.name.startswith("stage_")]
    assert len(names) == 3
    t.drop_stages()
    assert not [x.name for x in spark.catalog.listTables() if x.name.startswith("stage_")]
