"""Physical-plan checks: partitioning, pushdown, broadcast, no Python on the row path, invariance."""

import pytest

import __spark_entry__ as E
from tests.accounting import account
from tests.conftest import SF_SMALL
from tidewater.plans import common


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_windows_not_single_partition(spark):
    p = plan(common.features_v(spark, SF_SMALL))
    assert "Window" in p
    assert "SinglePartition" not in p


def test_filters_and_columns_pushed_to_scan(spark):
    df = E.queries()["P8_equality_filter"](spark, SF_SMALL)
    df.explain("formatted")
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in s
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in s


def test_period_tagging_is_broadcast_equi_join(spark):
    p = plan(E.queries()["J3_range_join_periods"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


@pytest.mark.parametrize("name", ["flagship_busiest_hours", "W1_lags", "W14_back_fill", "E7_stratified_split",
                                  "A7_exact_quantile", "V4_roc_auc", "W12_sequence_id"])
def test_results_invariant_to_shuffle_partitions(spark, name):
    q = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    outs = []
    try:
        for n in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            outs.append(sorted(map(tuple, q(spark, SF_SMALL).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert outs[0] == outs[1] == outs[2]


# Reads beyond two, over all jobs of a query, and why.
READS = {"A16_numeric_profile": 3}  # sums; first cells; the values in them
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "PythonMapInArrow", "MapInArrow",
          "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInPandas", "FlatMapCoGroupsInArrow",
          "FlatMapGroupsInPandasWithState", "TransformWithStateInPandas", "TransformWithStateInPySpark")
# Distances of whole blocks, a keyed state function: Arrow batches by design.
BATCHES = ("M5_knn_classify", "X3_stream_keyed_lags")


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_work_of_the_whole_query(spark, name):
    """Over all jobs: a query reads a table twice at most, has no cross product, and no Python on rows."""
    if name.startswith("op"):
        pytest.skip("accounted for by its own tests")
    with account(spark) as did:
        E.queries()[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    reads = did.scans(SF_SMALL)
    assert reads, name
    assert max(reads.values()) <= READS.get(name, 2), (name, dict(reads))
    assert not did.count("CartesianProduct")
    if name not in BATCHES:
        assert not did.count(*PYTHON), name


def test_the_split_reads_and_hashes_its_input_once(spark):
    with account(spark) as did:
        E.queries()["E7_stratified_split"](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    assert did.scans(SF_SMALL) == {"lineitem": 1}


def test_a_profile_of_all_columns_shares_its_passes(spark):
    with account(spark) as did:
        E.queries()["A16_numeric_profile"](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    assert did.scans(SF_SMALL)["customer"] <= 3 and did.jobs <= 12, (did.scans(SF_SMALL), did.jobs)


@pytest.mark.parametrize("name", ["F9_granularity_strategy", "F10_effective_weight", "F11_quality_band", "F12_recent_flag",
                                  "F13_granularity_columns", "S4_value_fallback", "A1_hourly_summary"])
def test_checked_columns_are_not_constant(spark, name):
    rows = E.queries()[name](spark, SF_SMALL).toPandas()
    assert {c for c in rows.columns if rows[c].nunique(dropna=False) < 2} == set()
    if name == "F9_granularity_strategy":
        assert rows["collection_strategy"].nunique() == 12
    if name == "F11_quality_band":
        assert set(rows["data_quality"]) == {"high", "medium", "low"}
    if name == "F13_granularity_columns":
        assert rows["granularity_category"].nunique() == 4


def test_halo_is_as_deep_as_the_features_asked_for(spark):
    from tidewater.operators import temporal, traffic
    depths, plain = [], temporal.windowed
    try:
        temporal.windowed = lambda *a, **k: (depths.append(k["before"]), plain(*a, **k))[1]
        common.window_features(spark, SF_SMALL, "tpm_lag_5", "response_time_lag_1")
        common.window_features(spark, SF_SMALL, "tpm_change")
        assert depths == [5, 1] and max(traffic.feature_depths().values()) == 11
    finally:
        temporal.windowed = plain
