"""Plan shape and skew: the properties that matter at scale, checked on small data.

1. No registered query plans a cartesian product, a nested-loop join or Python evaluation.
2. The latest-state aggregates and the latest-per-zone windows reduce before their shuffle.
3. With one zone holding over a third of all messages the answers still equal the DuckDB twins.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from zoneflow.plans import catalog as E
from conftest import SF_CHECK, SF_SMALL
from oracle_check import compare

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_no_cartesian_or_python_nodes(spark, name):
    plan = executed_plan(E.QUERIES[name](spark, SF_SMALL))
    assert not [n for n in FORBIDDEN if n in plan], plan


def test_latest_state_is_partial_before_shuffle(spark):
    plan = executed_plan(E.QUERIES["jn_02_latest_state_merge"](spark, SF_SMALL))
    assert "partial_max_by" in plan


def test_latest_window_is_limited_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan shows both limits
    try:
        plan = executed_plan(E.QUERIES["wn_01_latest_reading"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("WindowGroupLimit") >= 2, plan


def test_history_shuffles_the_grid_once(spark):
    # as for tables too big to broadcast: the grid and the readings meet in one exchange on
    # (zone, segment), and the carry-in is a union and a window too: the one join is that of each
    # zone's ticks with the non-empty ticks
    import re
    from zoneflow.operators import history as H
    from zoneflow.plans import catalog as C
    from zoneflow.plans.params import AS_OF, TICK
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                           "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(H.replay_states(C.message_cols(spark, SF_SMALL), AS_OF, TICK))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("SortMergeJoin") == 1, plan
    assert not re.search(r"hashpartitioning\(norm_zone#\d+, synchronized_time#\d+", plan), plan


def test_three_way_join_is_limited_before_each_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = executed_plan(E.QUERIES["jn_01_three_way_join"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one exchange a feed, by zone, after a partial limit; the joins add none of their own
    assert plan.count("WindowGroupLimit") == 6 and plan.count("Exchange hashpartitioning") == 3, plan


def test_only_the_zone_is_parsed_before_the_reduction(spark):
    for name in ("jn_02_latest_state_merge", "unified_snapshot"):
        plan = E.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("Aggregate [", 1)
        assert above.count("from_json(StructField(sensor_id") >= 3, plan
        assert "from_json(StructField(sensor_id" not in below and "from_json(StructField(zone" in below, plan


def test_rejects_parse_a_sound_payload_once(spark):
    from zoneflow.operators.parse import rejected_messages, valid_messages
    for split in (rejected_messages, valid_messages):
        plan = split(E.message_cols(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
        # once in the generator, for every message; all other forms are in the branch of what did not parse there
        above, generator = plan.split("Generate ", 1)
        assert generator.count("from_json(") == 1, plan
        later = [line.split("from_json(", 1)[0] for line in above.splitlines() if "from_json(" in line]
        assert later and all("_corrupt_record)) THEN" in before for before in later), plan


def test_replay_scans_are_pruned(spark):
    import re
    plan = executed_plan(E.QUERIES["status_breakdown"](spark, SF_SMALL))
    scans = re.findall(r"ReadSchema: (.*)", plan)
    assert scans and "Scan ExistingRDD" not in plan
    assert any("reading" not in x for x in scans), scans  # the tick and first-tick branches


def test_deduplicated_range_read_prunes_dates(spark, tmp_path):
    from zoneflow.operators import metrics as M
    from zoneflow.plans.params import AS_OF
    from zoneflow.sinks.documents import DocumentSink, write_batches
    sink = DocumentSink(str(tmp_path))
    write_batches(E.history(spark, SF_SMALL).withColumn("batch_id", F.lit(0)), sink.path)
    plan = executed_plan(M.summary(sink.read(spark, keep_date=True), AS_OF, 60))
    partition = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "sync_date" in partition and ">=" in partition, plan


def test_zone_lookup_scan_is_pruned(spark):
    plan = executed_plan(E.QUERIES["jn_04_zone_dimension_lookup"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan, plan


SKEW_QUERIES = ("unified_snapshot", "jn_01_three_way_join", "jn_02_latest_state_merge",
                "wn_01_latest_reading", "jn_03_history_replay", "summary", "zone_analytics",
                "trends", "status_breakdown", "latest")


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    """The sf0.01 events with every even event moved to one zone (FC Road, same spelling):
    that zone then holds well over a third of all messages, in every feed."""
    out = str(tmp_path_factory.mktemp("skewed"))
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    hot = F.when(F.col("event_id") % 2 == 0, F.col("user_id") - F.col("user_id") % 10)
    (ev.withColumn("user_id", hot.otherwise(F.col("user_id")))
     .repartition(4).write.parquet(os.path.join(out, "events.parquet")))
    return out


@pytest.fixture(scope="module")
def skewed_con(skewed_dir):
    con = duckdb.connect()
    con.execute("CREATE VIEW events AS SELECT * FROM "
                f"read_parquet('{skewed_dir}/events.parquet/*.parquet')")
    return con


def test_skewed_fixture_is_skewed(skewed_con):
    share = skewed_con.sql("SELECT avg(CASE WHEN user_id % 5 = 0 THEN 1.0 ELSE 0.0 END) "
                           "FROM events").fetchall()[0][0]
    assert share > 1 / 3


@pytest.mark.parametrize("name", SKEW_QUERIES)
def test_skewed_zone_matches_oracle(spark, skewed_dir, skewed_con, name):
    r = compare(spark, name, E.QUERIES[name], E.SQL[name], skewed_dir, skewed_con)
    assert r["status"] == "ok", r
