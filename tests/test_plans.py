"""Plan checks: pushdown, pruning, no cross joins, bounded exchanges."""

from loomlog.plans import catalog
from loomlog.plans import corpora as C
from loomlog.sources import records
from loomlog import schemas as S

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_filter_reaches_scan(spark):
    p = plan(catalog.events_at_hour(spark, SF))
    assert "PartitionFilters: [isnotnull(date_utc" in p and "(hour_utc" in p


def test_count_prunes_columns_and_combines_map_side(spark):
    p = plan(catalog.count_by_type(spark, SF))
    assert "ReadSchema: struct<event_type:string>" in p
    assert "partial_count" in p


def test_top_per_hour_has_no_cross_join_or_window(spark):
    p = plan(catalog.top_repo_per_hour(spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert bad not in p
    assert p.count("partial_min") >= 1


def test_interest_join_broadcasts_the_list(spark):
    for q in (catalog.interest_fork_activity, catalog.interest_activity):
        p = plan(q(spark, SF))
        assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
        assert "BroadcastNestedLoopJoin" not in p


def test_interest_list_over_the_threshold_is_not_broadcast(spark):
    # A list larger than autoBroadcastJoinThreshold gets no hint: the plan
    # falls back to a shuffle join, with the same result.
    expected = {q: sorted(q(spark, SF).collect()) for q in
                (catalog.interest_fork_activity, catalog.interest_activity)}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        for q, rows in expected.items():
            df = q(spark, SF)
            p = plan(df)
            assert "BroadcastHashJoin" not in p and "BroadcastExchange" not in p
            assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
            assert sorted(df.collect()) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_record_grouping_moves_edges_only(spark):
    """Records inside a split come from the scan's stage; the exchanges carry the
    splits' edges and, for their owners, rows without text."""
    path = C.case_vote_text(spark, SF)
    df = records.group_records(spark, path, S.CASE_VOTE_HEADER_REGEX)
    records_inside, rest = df._jdf.queryExecution().optimizedPlan().children().apply(0), df.count()
    assert "Exchange" not in records_inside.toString() and "Window" not in records_inside.toString() and rest > 0
    p = plan(df)
    assert "REPARTITION_BY" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    edges = records._cut(records.positioned_lines(spark, path), S.CASE_VOTE_HEADER_REGEX, "edges")
    splits = edges.select("file", "block").distinct().count()
    assert edges.count() <= 2 * splits


def test_sizes_and_skips_read_no_text_after_the_scan(spark):
    lines = records.positioned_lines(spark, C.case_vote_text(spark, SF))
    p = plan(records.skipped_records(lines, S.CASE_VOTE_HEADER_REGEX, 48))
    moved = [line for line in p.splitlines() if "Exchange" in line or "MapInArrow" in line]
    assert moved and all("value" not in line and "lines" not in line for line in moved)
