"""Every plan against the SQL that says the same."""

from __future__ import annotations

import pytest
from conftest import DATA, rows_of

from tessera.plans import registry

NAMES = sorted(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_plan_gives_the_rows_of_its_sql(spark, duck, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    sql = registry.oracle_sql().get(name)
    assert len(got.columns) == len(set(got.columns))
    if sql is not None:
        want = duck.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got, sorted(got.columns)) == rows_of(want, sorted(got.columns))


def test_every_plan_says_what_it_does():
    import importlib

    for m in registry.MODULES:
        module = importlib.import_module(f"tessera.plans.{m}")
        for name in NAMES:
            if hasattr(module, name) and getattr(module, name).__module__ == module.__name__:
                assert getattr(module, name).__doc__
