"""The stored warehouse: layers under one root, refreshed from the landing zone.

``refresh`` runs one pass of every hop: raw, cleansed, the dimensions, then the
facts. Called again, each hop continues where its checkpoint stands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strataflow.functions.rules import rules_of
from strataflow.operators.changes import ACTION, DELETE, INSERT, change_log, unmatched
from strataflow.operators.dimensions import calendar, junk_dimension
from strataflow.operators.facts import RUN_TYPE, joined_runs
from strataflow.operators.keys import last_key
from strataflow.plans.hospital.catalog import TABLES, quality_rules
from strataflow.plans.hospital.dimensions import ALL_DIMENSIONS, DIMENSIONS, PROFILES, load_dimension
from strataflow.plans.hospital.facts import (
    FACT_KEYS,
    FACT_SK,
    FACTS,
    found_keys,
    load_fact,
    numbered,
    trial_coverage,
    with_missing,
)
from strataflow.plans.hospital.views import serving_views
from strataflow.session import materialize, read_or_none
from strataflow.sources.schema import TECHNICAL_COLUMNS
from strataflow.streaming.loads import Load, Loads
from strataflow.streaming.merged import MergedTables
from strataflow.streaming.refresh import Hop, follow_changed, follow_cleansed, follow_raw
from strataflow.streaming.snapshots import Snapshots


def initial_star(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    as_of: date,
    days: tuple[date, date] | None = None,
    parity: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All dimensions, stored, and all facts of a first load from cleansed tables."""
    dims = {"dim_fecha": calendar(spark, *days) if days else calendar(spark)}
    for name in (*DIMENSIONS, *PROFILES):
        dims[name] = materialize(load_dimension(spark, name, tables, None, as_of), name)
    facts = {}
    for name, main in FACTS.items():
        facts[name] = numbered(load_fact(name, tables[main], tables, dims, as_of, None, parity), name)
    return dims, facts


def _side_by_side(work: Callable[[str], Any], names: Iterable[str], at_once: int = 8) -> list:
    """What ``work`` gives for each name. Its many small jobs leave most cores idle one by one."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(work, names))


class Warehouse:
    """``schemas`` are those of the landing tables in use, by table name.

    ``retry`` keeps main rows of a fact that miss a dimension or source row by
    the keys they miss, and loads them once those are there; without it they
    are lost, as in the source system.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schemas: Mapping[str, T.StructType],
        buckets: int = 64,
        calendar_days: tuple[date, date] | None = None,
        parity: bool = False,
        retry: bool = False,
    ):
        self.spark, self.root, self.landed = spark, root, dict(schemas)
        self.buckets, self.days, self.parity, self.retry = buckets, calendar_days, parity, retry
        self.rules = quality_rules(parity)
        # what is read again and again while one refresh loads dimensions, then facts
        self._tables: dict[str, DataFrame] = {}
        self._dims: dict[str, DataFrame] = {}
        self.hops = {name: self._hop(name, schema) for name, schema in self.landed.items()}

    def _hop(self, name: str, schema: T.StructType) -> Hop:
        kept = T.StructType([f for f in schema.fields if f.name.lower() not in TECHNICAL_COLUMNS])
        return Hop(name, TABLES[name].key, kept, self.root)

    # --- what is stored -------------------------------------------------

    def raw(self, name: str) -> DataFrame:
        return self.hops[name].raw(self.spark).read("rows")

    def cleansed(self, name: str) -> DataFrame:
        return self.hops[name].cleansed(self.spark).read("valid")

    def errors(self, name: str) -> DataFrame:
        return self.hops[name].cleansed(self.spark).read("errors")

    def _cleansed_tables(self) -> dict[str, DataFrame]:
        """All cleansed tables; during a refresh as its hops have left them."""
        return self._tables or dict(zip(self.hops, _side_by_side(self.cleansed, self.hops)))

    def _store(self, dimension: str) -> Snapshots:
        key = DIMENSIONS[dimension].key
        return Snapshots(
            self.spark, f"{self.root}/conformed/{dimension}", {"rows": None}, [key], self.buckets
        )

    def dimension(self, name: str) -> DataFrame | None:
        if name == "dim_fecha":
            return calendar(self.spark, *self.days) if self.days else calendar(self.spark)
        if name in PROFILES:
            return read_or_none(self.spark, f"{self.root}/conformed/{name}")
        return self._store(name).read("rows")

    def dimensions(self) -> dict[str, DataFrame]:
        if self._dims:
            return self._dims
        found = zip(ALL_DIMENSIONS, _side_by_side(self.dimension, ALL_DIMENSIONS))
        return {name: dim for name, dim in found if dim is not None}

    def _loads(self, name: str) -> Loads:
        return Loads(self.spark, f"{self.root}/conformed/{name}", FACT_KEYS[name][0], FACT_SK[name])

    def _waiting(self, name: str) -> MergedTables:
        """Main rows of a fact that miss something, with what they miss."""
        hop = self.hops[FACTS[name]]
        schema = T.StructType([*hop.schema.fields, T.StructField("falta", T.ArrayType(T.StringType()))])
        return MergedTables(self.spark, f"{self.root}/pending/{name}", {"rows": schema}, hop.keys)

    def _days(self, name: str) -> MergedTables:
        """The days that a fact of intervals has already, as runs."""
        key = FACT_KEYS[name][0]
        schema = T.StructType().add(key, T.LongType()).add("tramos", RUN_TYPE)
        return MergedTables(self.spark, f"{self.root}/coverage/{name}", {"rows": schema}, [key])

    def fact(self, name: str) -> DataFrame | None:
        fact = self._loads(name).read()
        return None if fact is None else fact.drop("mes")

    def waiting(self, name: str) -> DataFrame:
        return self._waiting(name).read("rows")

    def views(self, all_versions: bool = False) -> dict[str, DataFrame]:
        facts = {name: self.fact(name) for name in FACTS}
        return serving_views(facts, self.dimensions(), all_versions)

    # --- loads ------------------------------------------------------------

    def _load_profile(self, name: str) -> None:
        sk, axes = PROFILES[name]
        if self.dimension(name) is None:
            junk_dimension(self.spark, axes, sk).write.parquet(f"{self.root}/conformed/{name}")

    def _load_dimension(self, name: str, changed: DataFrame, batch: int, as_of: date) -> None:
        store = self._store(name)
        if store.holds(batch):
            return
        spec = DIMENSIONS[name]
        changed = materialize(changed, name)
        # departments depend on each other, so all of them are read and written
        whole = name == "dim_departamento"
        buckets = list(range(self.buckets)) if whole else store.touched(changed)
        existing = store.read("rows", buckets)
        last = last_key(store.read("rows"), spec.sk)
        dim = load_dimension(
            self.spark, name, self._cleansed_tables(), existing, as_of, changed, last
        )
        store.publish(batch, {"rows": dim}, buckets)

    def _held(self, name: str, rows: DataFrame) -> DataFrame | None:
        """What the fact has already of the main rows: their days, or rows with their keys."""
        if name == "fact_ensayos_clinicos":
            return self._days(name).held("rows", rows)
        near = self._loads(name).near(rows, TABLES[FACTS[name]].key[0])
        return None if near is None else near.drop("mes")

    def _load_fact(self, name: str, batch_rows: DataFrame, batch: int, as_of: date) -> None:
        """Load a batch of main rows. Each step of it is done once, whenever it is repeated."""
        loads = self._loads(name)
        follows = [*([self._waiting(name)] if self.retry else []), *self._by_days(name)]
        if loads.holds(batch) and all(s.holds(loads.loads()[-1].load) for s in follows):
            return
        rows = materialize(batch_rows, name)
        if not loads.holds(batch):
            self._add(name, loads, rows, batch, as_of)
        self._follow(name, loads, rows)

    def _by_days(self, name: str) -> list[MergedTables]:
        return [self._days(name)] if name == "fact_ensayos_clinicos" else []

    def _add(self, name: str, loads: Loads, rows: DataFrame, batch: int, as_of: date) -> Load:
        self._cover(name, loads)
        fresh = load_fact(
            name, rows, self._cleansed_tables(), self.dimensions(), as_of, self._held(name, rows), self.parity
        )
        placed = numbered(fresh, name, loads.last_key()).withColumn("mes", F.floor(F.col("sk_fecha") / 100).cast("int"))
        return loads.publish(batch, placed, "mes")

    def _cover(self, name: str, loads: Loads) -> None:
        """Enter the days of loads that are not entered yet. They are taken from the loads
        themselves, so a load that was cut off in between is made up for."""
        for days in self._by_days(name):
            for entry in loads.loads():
                if days.holds(entry.load):
                    continue
                key, loaded = days.keys[0], loads.read([entry.load])
                log = days.read("rows").limit(0).select(F.lit(INSERT).alias(ACTION), "*")
                if loaded is not None:
                    runs = trial_coverage(loaded)
                    before = days.held("rows", runs)
                    each = runs.unionByName(before).select(key, F.inline("tramos"))
                    after = materialize(joined_runs(each, key).withColumn(ACTION, F.lit(INSERT)), "days")
                    log = change_log(before, after, [key])
                days.publish(entry.load, {"rows": log})

    def _follow(self, name: str, loads: Loads, rows: DataFrame) -> None:
        """Enter what the newest load covers, and which of its main rows wait."""
        self._cover(name, loads)
        newest = loads.loads()[-1].load
        if self.retry and not (waiting := self._waiting(name)).holds(newest):
            asked = with_missing(rows, name, self._cleansed_tables(), self.dimensions())
            asked = materialize(asked, "missing")
            before = waiting.held("rows", asked)
            acts = F.when(F.size("falta") > 0, INSERT).otherwise(DELETE)
            waiting.publish(newest, {"rows": change_log(before, asked.withColumn(ACTION, acts), waiting.keys)})

    def _wake(self, name: str, as_of: date) -> None:
        """Load waiting rows that no longer miss what they waited for.

        Rows are found by the keys they miss, so those that still wait are not looked at.
        """
        waiting, loads = self._waiting(name), self._loads(name)
        held = waiting.read("rows")
        if not loads.loads() or held.isEmpty():
            return
        index = materialize(held.select(*waiting.keys, F.explode("falta").alias("falta")), "index")
        wanted = index.select("falta").distinct()
        there = found_keys(name, self._cleansed_tables(), self.dimensions()).join(wanted, "falta", "left_semi").distinct()
        still = index.join(materialize(there, "there"), "falta", "left_anti").select(*waiting.keys).distinct()
        woken = materialize(unmatched(held, still, waiting.keys).drop("falta"), "woken")
        if not woken.isEmpty():
            self._add(name, loads, woken, loads.batch(), as_of)
            self._follow(name, loads, woken)

    # --- refresh ------------------------------------------------------------

    def _run(self, start, paths: Mapping[str, str], at_once: int = 8) -> None:
        """Run one pass of a hop for several tables side by side.

        ``paths`` tells where each reads from; one with nothing there yet waits.
        """

        def run(name: str) -> None:
            if read_or_none(self.spark, paths[name], "lote long") is not None:
                start(name).awaitTermination()

        _side_by_side(run, paths, at_once)

    def refresh(self, landing: str, as_of: date, **options) -> None:
        """One pass of all hops; dimensions before facts."""
        try:
            self._refresh(landing, as_of, **options)
        finally:
            self._tables, self._dims = {}, {}

    def _refresh(self, landing: str, as_of: date, **options) -> None:
        spark = self.spark
        self._run(
            lambda n: follow_raw(spark, self.hops[n], landing, self.landed[n], **options),
            {n: f"{landing}/{n}" for n in self.hops},
        )
        self._run(
            lambda n: follow_cleansed(spark, self.hops[n], rules_of(self.rules, n)),
            {n: hop.log("raw") for n, hop in self.hops.items()},
        )
        self._tables = self._cleansed_tables()
        _side_by_side(self._load_profile, PROFILES)
        logs = {n: hop.log("cleansed") for n, hop in self.hops.items()}
        self._run(
            lambda n: follow_changed(
                spark, self.hops[DIMENSIONS[n].main], n,
                lambda rows, batch: self._load_dimension(n, rows, batch, as_of),
            ),
            {n: logs[spec.main] for n, spec in DIMENSIONS.items() if spec.main in logs},
        )
        self._dims = self.dimensions()
        self._run(
            lambda n: follow_changed(
                spark, self.hops[FACTS[n]], n, lambda rows, batch: self._load_fact(n, rows, batch, as_of)
            ),
            {n: logs[main] for n, main in FACTS.items() if main in logs},
        )
        if self.retry:
            # no fact reads what another one loads
            _side_by_side(lambda n: self._wake(n, as_of), [n for n, main in FACTS.items() if main in logs])

    def load_object(self, name: str, as_of: date) -> DataFrame:
        """Load one dimension, or the missing rows of a fact, from all cleansed rows.

        Brings attributes looked up in other tables up to date and extends open
        intervals to ``as_of``, which a refresh does only for changed rows.
        What is loaded is stored as a refresh would store it, and read back:
        the dimension, or the rows that the fact gained.
        """
        if name == "dim_fecha":
            return self.dimension(name)
        if name in PROFILES:
            self._load_profile(name)
            return self.dimension(name)
        tables = self._cleansed_tables()
        if name in DIMENSIONS:
            store = self._store(name)
            dim = load_dimension(self.spark, name, tables, store.read("rows"), as_of)
            store.publish(store.batch(), {"rows": dim}, range(self.buckets))
            return store.read("rows")
        loads, rows = self._loads(name), materialize(tables[FACTS[name]], name)
        before = self.fact(name)
        gained = self._add(name, loads, rows, loads.batch(), as_of)
        self._follow(name, loads, rows)
        found = loads.read([gained.load])
        if found is None:
            return before if before is None else before.limit(0)
        return found.drop("mes")
