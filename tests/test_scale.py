"""Shapes of plans that matter on large data."""

import re
from contextlib import contextmanager
from datetime import date
from functools import reduce

import pyarrow as pa
import pytest
from pyspark.sql import DataFrame, functions as F

from strataflow.functions.rules import not_null, positive
from strataflow.operators import changes as cdc
from strataflow.operators.asof import as_of_lookup
from strataflow.operators.facts import daily_rows, day_runs, joined_runs, recurrence_flag
from strataflow.operators.quality import valid_rows
from strataflow.operators.scd import scd1_rows, scd2_merge, scd2_rows
from strataflow.plans import queries
from strataflow.plans.hospital import views
from strataflow.session import materialize

SF = "/root/testdata/sf0.01"


@contextmanager
def conf(spark, **settings):
    """Settings by name with ``__`` for the dots, put back afterwards."""
    names = {"spark.sql." + k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    """The final plan after running ``df`` with all its columns."""
    result = df.agg(F.bit_xor(F.xxhash64(*df.columns)))
    result.collect()
    return result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


@pytest.fixture(scope="module")
def hot(spark):
    """Line items of which a quarter share one key and one month."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    is_hot = F.col("l_linenumber") <= 2
    stamp = F.timestamp_seconds(F.lit(920592000) + F.col("l_quantity").cast("int") * 3600)
    return materialize(lines.select(
        F.monotonically_increasing_id().alias("id"),
        F.when(is_hot, -1).otherwise(F.col("l_partkey")).alias("k"),
        F.when(is_hot, stamp).otherwise(F.col("l_shipdate").cast("timestamp")).alias("at"),
        F.col("l_returnflag").alias("kind"),
    ).repartition(8))


@pytest.fixture
def unhinted(spark):
    settings = {
        "autoBroadcastJoinThreshold": "-1",
        "adaptive__autoBroadcastJoinThreshold": "-1",
        "adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
        "adaptive__advisoryPartitionSizeInBytes": "20KB",
        "adaptive__coalescePartitions__enabled": "false",
        "shuffle__partitions": "32",
    }
    with conf(spark, **settings):
        yield


def test_recurrence_splits_a_hot_key(spark, hot, unhinted):
    flagged = recurrence_flag(hot, hot, "k", "at", F.col("kind") == "R", "again")
    assert "skew=true" in executed(flagged)
    assert flagged.count() == hot.count()


def test_visits_of_a_hot_interval_are_split(spark, hot, unhinted):
    spans = materialize(hot.groupBy("k").agg(F.min("at").alias("a"), F.max("at").alias("b")))
    daily = daily_rows(
        spans, hot.select("k", "at", F.col("id").alias("n")), "k", "a", "b", "at", "dia", date(2002, 1, 1)
    )
    assert "skew=true" in executed(daily)
    assert daily.filter("n IS NOT NULL").count() == hot.count()


def test_newest_change_is_cut_down_before_the_shuffle(spark, hot):
    newest = cdc.newest_change(hot.withColumn(cdc.ACTION, F.lit(cdc.INSERT)), ["k"], ["at"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and partial > plan.index("Exchange")


def test_small_batches_leave_the_table_unshuffled(spark, hot):
    table = hot.dropDuplicates(["k"])
    table = materialize(table)
    changes = materialize(table.limit(5).withColumn(cdc.ACTION, F.lit(cdc.DELETE)))
    assert "Exchange hashpartitioning" not in executed(cdc.apply_changes(table, changes, ["k"]))


def test_rules_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_totalprice")
    rules = positive("o_totalprice") + not_null("o_orderkey")
    plan = valid_rows(orders, rules)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,0.0)" in plan and "IsNotNull(o_orderkey)" in plan
    assert "o_custkey" not in plan


def test_scd_reads_its_source_and_the_dimension_once(spark, hot):
    dim = materialize(hot.dropDuplicates(["k"]).select(
        F.col("id").alias("sk"), "k", "kind", F.to_date("at").alias("fecha_inicio"),
        F.lit(None).cast("date").alias("fecha_fin"), F.lit(True).alias("es_actual"),
    ))
    source = materialize(dim.select("k", F.lit("z").alias("kind")))
    for rows in (scd2_rows(dim, source, "k", [], ["kind"], date(2024, 1, 1)), scd1_rows(dim.select("sk", "k", "kind"), source, "k", ["kind"])):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 2 and plan.count("Join ") == 1
    loaded = scd2_merge(dim, source, "k", [], ["kind"], "sk", date(2024, 1, 1), last=10**9)
    assert loaded.count() == 2 * dim.count() and loaded.filter("es_actual").count() == dim.count()


def test_as_of_lookup_deals_a_hot_key_to_several_tasks(spark, hot):
    versions = spark.range(40).select((F.col("id") % 4 - 1).alias("k"), F.col("id").alias("sk"), F.timestamp_seconds(F.lit(800000000) + F.col("id") * 9000000).alias("desde"))
    found = as_of_lookup(hot, versions, "k", "at", "desde", ["sk"], tie="sk", slice_rows=1000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "_slice" in plan.split("hashpartitioning(_key")[1][:80]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    seen = []

    def sizes(batches):
        n = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_pydict({"n": [n]})

    with conf(spark, adaptive__enabled="false", shuffle__partitions="32"):
        seen = [r.n for r in found.mapInArrow(sizes, "n long").collect()]
    share = hot.filter("k = -1").count()
    assert sum(seen) == hot.count() and max(seen) < share / 3


def test_loaded_days_are_taken_from_runs(spark, hot):
    spans = materialize(hot.groupBy("k").agg(F.min("at").alias("a"), F.max("at").alias("b")))
    held = materialize(joined_runs(day_runs(hot.filter("id % 2 = 0"), "k", "at"), "k"))
    daily = daily_rows(spans, hot.select("k", "at", F.col("id").alias("n")), "k", "a", "b", "at", "dia", date(2002, 1, 1), held)
    gone = hot.filter("id % 2 = 0").select("k", F.to_date("at").alias("dia"))
    assert daily.join(gone, ["k", "dia"], "left_semi").isEmpty()
    whole = daily_rows(spans, hot.select("k", "at", F.col("id").alias("n")), "k", "a", "b", "at", "dia", date(2002, 1, 1))
    assert daily.count() == whole.join(gone.distinct(), ["k", "dia"], "left_anti").count()


def _star(spark, name):
    """A fact, its dimensions and what its view returns, as the registered queries have them."""
    fact = queries.stored(spark, SF, name, lambda: queries._fact(spark, SF, name))
    return fact, queries.star_dimensions(spark, SF, "dim_fecha", *queries.FACT_INPUTS[name][1])


@pytest.mark.parametrize("name", ["fact_mantenimiento_equipos", "fact_monitorizacion_pacientes"])
def test_views_look_up_days_after_the_shuffles(spark, unhinted, name):
    plan = executed(views.FACT_VIEWS[name](*_star(spark, name)))
    shuffles = [at for at, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning(sk_" in line]
    days = [at for at, line in enumerate(plan.splitlines()) if "BroadcastHashJoin" in line and "sk_fecha" in line]
    assert days and len(shuffles) > 3 and max(days) < min(shuffles)


def test_days_of_trials_are_shuffled_once_in_counted_tasks(spark, unhinted, rows, monkeypatch):
    fact, dims = _star(spark, "fact_ensayos_clinicos")
    keys = [c for c in fact.columns if c.startswith("sk_")]
    odd = [fact.limit(3).withColumn(k, F.lit(None).cast(dict(fact.dtypes)[k])) for k in keys if k != "sk_fecha_fin"]
    some = materialize(reduce(DataFrame.unionByName, [fact, fact.limit(500), *odd]))
    monkeypatch.setattr(views, "DAYS_PER_TASK", fact.count() // 50)
    view = views.trial_view(some, dims)
    plan = executed(view)
    shuffled = [x for x in plan.splitlines() if "Exchange hashpartitioning(sk_" in x and "ENSURE" not in x]
    assert len(shuffled) == 1 and int(re.search(r", (\d+)\)", shuffled[0])[1]) >= 50
    monkeypatch.setattr(views, "DAYS_PER_TASK", some.count())
    assert rows(view) == rows(views.trial_view(some, dims))
    assert view.count() == views.trial_view(fact, dims).count() + views.trial_view(materialize(fact.limit(500)), dims).count()
