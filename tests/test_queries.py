"""A query of each area against its DuckDB twin on the smallest tables."""

import duckdb
import numpy as np
import pytest

from claimlens.plans import registry

NAMES = ["pit_base_rate", "reason_repeat", "related_accounts", "policy_features", "sdk_orders", "uv_edges", "uv_edge_asof_order", "dispositions", "entity_scores", "time_split", "daily_refund_series", "history_pruned", "review_sample", "uv_null_by_day", "uv_edge_asof_null", "log_baselines", "log_cohorts", "stratified_folds", "edge_reconstruction", "reconstruction_nodes", "history_recent", "graph_export", "clean_export"]


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, sf, duck, name):
    a, b = registry.queries()[name](spark, sf).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    a, b = (x[cols].sort_values([c for c in cols], ignore_index=True) for x in (a, b))
    assert len(a) == len(b)
    for c in cols:
        if a[c].dtype.kind in "fiu":
            assert np.allclose(a[c].astype(float), b[c].astype(float), atol=1e-9, equal_nan=True), c
        elif a[c].dtype.kind != "M":
            assert (a[c].astype(str) == b[c].astype(str)).all(), c


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
