"""Physical-plan properties that matter at scale."""

import datetime as dt
import re

import pytest

from casebook.plans.registry import QUERIES
from casebook.sources import tables

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udf_no_cartesian(spark, key):
    p = _plan(QUERIES[key](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, (key, bad)


@pytest.mark.parametrize("key", ["loyalty_top_item", "web_top_pages", "web_top_products",
                                 "web_most_abandoned", "web_view_to_purchase"])
def test_top_k_is_take_ordered(spark, key):
    df = QUERIES[key](spark, SF)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().sparkPlan().toString()


def test_impact_unpivots_in_one_pass(spark):
    df = QUERIES["mart_impact_by_area"](spark, SF)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "Expand" in p
    assert p.count("lineitem.parquet") == 1     # one scan feeds all five dimensions


def test_pruned_scans(spark):
    df = QUERIES["bank_realloc_days_all"](spark, SF)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "o_totalprice" not in p               # unused columns are not read


def test_filters_reach_the_scan(spark):
    df = QUERIES["loyalty_points_join_week"](spark, SF)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]",
                        df._jdf.queryExecution().executedPlan().toString())
    assert any("LessThan" in x and "o_orderdate" in x for x in pushed), pushed


@pytest.fixture
def large_tables(spark):
    """Plans as for tables too large to broadcast, without run-time changes."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("-1", "false")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def _counts(spark, key):
    p = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"[^d]Exchange hashpartitioning", p)), p.count("FileScan"), p


def test_lineitem_is_shuffled_once_for_the_weekly_table(spark, large_tables):
    _, _, p = _counts(spark, "mart_txn_by_year")
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", p)) == 1
    assert "Exchange hashpartitioning(l_orderkey#" in p
    assert not re.search(r"Exchange hashpartitioning\(l_orderkey#\w+, ", p.replace("L, 4)", ")")) \
        or "REPARTITION_BY_COL" in p


def test_the_weekly_table_gets_tasks_by_its_splits(spark, large_tables, monkeypatch):
    rows = {
        "lineitem": [(i % 100, 10.0 + i, "ANR"[i % 3], "OF"[i % 2], dt.datetime(1998, 1 + i % 12, 5)) for i in range(300)],
        "orders": [(i, i % 7) for i in range(100)], "customer": [(i, i % 2, "BUILDING") for i in range(7)],
        "nation": [(0, 0), (1, 1)], "region": [(0, "ASIA"), (1, "AFRICA")]}
    names = {"lineitem": ("l_orderkey long, l_extendedprice double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp_ntz"),
             "orders": "o_orderkey long, o_custkey long",
             "customer": "c_custkey long, c_nationkey long, c_mktsegment string",
             "nation": "n_nationkey long, n_regionkey long", "region": "r_regionkey long, r_name string"}
    given = {k: spark.createDataFrame(v, names[k]) for k, v in rows.items()}
    monkeypatch.setattr(tables.Tables, "raw", lambda self, name: given[name])

    def weekly():
        df = tables.Tables(spark, "").weekly_amounts
        return sorted(map(tuple, df.collect())), df._jdf.queryExecution().executedPlan().toString()
    lines = given["lineitem"]
    given["lineitem"] = lines.coalesce(1)
    want, p = weekly()
    assert "REPARTITION_BY_COL" in p and "REPARTITION_BY_NUM" not in p  # one split: Spark decides
    monkeypatch.setattr(tables, "TASKS_PER_SPLIT", 5)
    given["lineitem"] = lines.repartition(6, "l_orderkey")
    got, p = weekly()
    assert got == want and len(want) > 40
    assert re.search(r"hashpartitioning\(l_orderkey#\w+, 30\), REPARTITION_BY_NUM", p), p
    assert re.search(r"hashpartitioning\(o_orderkey#\w+, 30\)", p), p
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", p)) == 1


@pytest.mark.parametrize("key", ["mart_txn_by_platform", "mart_txn_by_year", "mart_missing_weeks",
                                 "mart_missing_weeks_year"])
def test_mart_tasks_follow_the_splits_of_lineitem(spark, key):
    want = sorted(map(tuple, QUERIES[key](spark, SF).collect()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        df = QUERIES[key](spark, SF)
        splits = tables.bind(spark, SF).raw("lineitem").rdd.getNumPartitions()
        assert splits >= spark.sparkContext.defaultParallelism
        wanted = rf"hashpartitioning\(l_orderkey#\w+, {splits * tables.TASKS_PER_SPLIT}\), REPARTITION_BY_NUM"
        assert re.search(wanted, _plan(df)), _plan(df)
        assert sorted(map(tuple, df.collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("key", ["mart_txn_by_platform", "mart_txn_by_year", "mart_missing_weeks",
                                 "mart_missing_weeks_year"])
def test_orders_meet_customers_in_tasks_by_their_splits(spark, large_tables, key):
    want = sorted(map(tuple, QUERIES[key](spark, SF).collect()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        df = QUERIES[key](spark, SF)
        tasks = tables.bind(spark, SF).raw("orders").rdd.getNumPartitions() * tables.TASKS_PER_SPLIT
        assert re.search(rf"hashpartitioning\(o_custkey#\w+, {tasks}\), REPARTITION_BY_NUM", _plan(df)), _plan(df)
        assert re.search(rf"hashpartitioning\(c_custkey#\w+, {tasks}\)", _plan(df)), _plan(df)
        assert len(re.findall(r"Exchange hashpartitioning\(o_custkey", _plan(df))) == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, df.collect())) == want


def test_fewer_splits_than_slots_are_dealt_by_splits_too(spark):
    """Many files may make fewer splits than slots, however large they are."""
    slots = spark.sparkContext.defaultParallelism
    line = [(i, 1.0, "A", "O", dt.datetime(1998, 1, 5)) for i in range(slots * 10)]
    li = spark.createDataFrame(line, "l_orderkey long, l_extendedprice double, l_returnflag string, "
                                     "l_linestatus string, l_shipdate timestamp_ntz")
    o = spark.createDataFrame([(i, i % 7) for i in range(50)], "o_orderkey long, o_custkey long")
    for splits, by_splits in ((slots - 1, True), (slots // 2 + 1, True), (slots // 2, False), (1, False)):
        dealt, orders = tables.Tables(spark, "")._dealt(li.repartition(splits, "l_orderkey"), o)
        assert ("REPARTITION_BY_NUM" in _plan(dealt)) == by_splits, splits
        assert ("REPARTITION_BY_NUM" in _plan(orders)) == by_splits, splits
        assert sorted(orders.collect()) == sorted(o.collect())


@pytest.mark.parametrize("key, exchanges, scans", [
    ("loyalty_first_items", 5, 3), ("loyalty_first_after_join", 6, 4),
    ("loyalty_last_before_join", 6, 4)])
def test_first_rows_read_their_facts_once(spark, large_tables, key, exchanges, scans):
    n, files, p = _counts(spark, key)
    assert n <= exchanges and files <= scans, p
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("key", ["loyalty_member_ranking", "web_visits_per_month",
                                 "bank_alloc_running"])
def test_windows_of_hot_keys_run_over_aggregates(spark, large_tables, key):
    """Below every window, before the scan, rows have been aggregated."""
    lines = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    found = 0
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            found += 1
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            assert any("Aggregate(" in x for x in below), line
    assert found


def test_ordered_strings_are_built_from_cart_adds_alone(spark, large_tables):
    p = QUERIES["web_visit_campaigns"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for line in p.splitlines():
        if "ObjectHashAggregate" in line or "SortAggregate" in line:
            assert ("listagg" in line or "collect_set(_at_level" in line) and "count(" not in line, line


@pytest.mark.parametrize("key", ["bank_node_count", "bank_customers_per_region",
                                 "web_events_by_type", "web_top_pages", "web_category_counts"])
def test_unused_lookups_are_pruned(spark, key):
    # Next-stay dates and visit numbers are joined back with left joins on
    # keys that always match; keys that never read them run no window.
    p = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in p, key


@pytest.mark.parametrize("key", [
    "mart_before_after_4w", "mart_before_after_4w_intent", "mart_before_after_12w", "mart_before_after_12w_intent",
    "mart_worst_area", "mart_change_week", "mart_missing_weeks", "mart_missing_weeks_year"])
def test_week_texts_are_parsed_after_the_weekly_aggregation(spark, large_tables, key):
    """No date is formatted or parsed on raw line items, below their exchange."""
    lines = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    found = 0
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(l_orderkey" in line:
            found += 1
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                assert "date_format" not in lines[j] and "gettimestamp" not in lines[j], lines[j]
    assert found
