"""Every registered query against its SQL text, and the driver contract."""

import glob
import os

import duckdb
import pandas as pd
import pytest
from check import difference, rows_of

import __spark_entry__ as entry
from panelweave.session import DEFAULT_GROUP_ROWS, GROUP_ROWS

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def compare(spark, db, name):
    got = rows_of(entry.queries()[name](spark, FOLDER))
    cursor = db.execute(entry.oracle_sql()[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
    assert difference(got, want) == ""


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    compare(spark, db, name)


SKEW_SENSITIVE = (
    "asof_backward", "asof_backward_max_age", "asof_by_known_date", "asof_forward", "carry_last_change", "change_points",
    "fill_backward", "every_nth_row", "shift_lag_lead", "days_since_last_event", "join_left_equi", "filter_membership",
    "override_by_keyset", "dedup_shift_day", "holdout_newest_pct", "purge_gap", "ts_folds", "describe_columns",
    "box_stats_by_group", "corr_spearman", "roc_auc", "roc_curve", "buy_signal_series", "impute_group_mean",
)


@pytest.mark.parametrize("name", SKEW_SENSITIVE)
def test_query_equals_sql_when_series_are_too_long_for_a_task(spark, db, name):
    spark.conf.set(GROUP_ROWS, "6")
    try:
        compare(spark, db, name)
    finally:
        spark.conf.set(GROUP_ROWS, str(DEFAULT_GROUP_ROWS))


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
