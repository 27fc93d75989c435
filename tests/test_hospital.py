"""The whole star on a small scale: keys, relations and views."""

from datetime import date

import pytest

from strataflow.plans.hospital import ingest
from strataflow.plans.hospital.dimensions import ALL_DIMENSIONS, CURRENT_ONLY, DIMENSIONS, PROFILES
from strataflow.plans.hospital.facts import FACT_SK, FACTS
from strataflow.plans.hospital.views import serving_views
from strataflow.plans.hospital.warehouse import initial_star
from strataflow.plans.roles import cleansed_tables
from strataflow.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    tables = cleansed_tables(spark, SF)
    dims, facts = initial_star(spark, tables, date(2001, 8, 10), (date(1995, 1, 1), date(2030, 12, 31)))
    return dims, {name: materialize(fact, name) for name, fact in facts.items()}


def test_dimensions_have_unique_keys(star):
    dims, _ = star
    assert set(dims) == set(ALL_DIMENSIONS)
    for name, dim in dims.items():
        sk = "sk_fecha" if name == "dim_fecha" else PROFILES[name][0] if name in PROFILES else DIMENSIONS[name].sk
        assert dim.select(sk).distinct().count() == dim.count() > 0


def test_facts_refer_to_existing_rows(star):
    dims, facts = star
    owners = {spec.sk: name for name, spec in DIMENSIONS.items()} | {sk: n for n, (sk, _) in PROFILES.items()}
    owners["sk_fecha"] = "dim_fecha"
    for name, fact in facts.items():
        assert fact.count() == fact.select(FACT_SK[name]).distinct().count() > 0
        for column in fact.columns:
            if column in owners and column != FACT_SK[name]:
                assert fact.join(dims[owners[column]], column, "left_anti").isEmpty(), (name, column)


def test_fifteen_views(star):
    dims, facts = star
    views = serving_views(facts, dims)
    assert len(views) == 15
    for name in FACTS:
        assert views[name].count() == facts[name].count()
    for name in CURRENT_ONLY:
        assert views[name].filter("NOT es_actual").isEmpty()


def test_feeds_cover_every_table():
    listed = ingest.feeds({"equipment": {"url": "jdbc:a"}, "clinical": {"url": "jdbc:b"}}, "/in")
    assert len(listed) == 21 and len({f.table for f in listed}) == 21
