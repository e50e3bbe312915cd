"""Physical shapes that results alone do not show: parses, scans and shuffles per query."""

import re

from rill import schemas
from rill.functions.json import parse_messages
from rill.plans.queries import BATCH_QUERIES
from rill.sources import replay
from rill.sources.tables import read_table
from rill.streaming import jobs as sjobs

from paths_for_tests import SF_SMALL


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_messages_are_parsed_once(spark):
    events = read_table(spark, SF_SMALL, "events")
    etl = optimized(sjobs.access_log_frame(replay.access_log_topic(events)))
    assert etl.count("from_json") == 1
    strict = parse_messages(replay.metric_topic(events), schemas.METRIC).where("url = 'view'").select("url")
    assert optimized(strict).count("from_json") == 1


def test_event_time_text_is_parsed_once(spark):
    plan = optimized(BATCH_QUERIES["site_count_20s"](spark, SF_SMALL))
    assert len(re.findall(r"gettimestamp", plan)) == 1


def test_readiness_scans_its_source_once(spark):
    for name in ("partitions_ready", "hourly_partitions_ready"):
        assert physical(BATCH_QUERIES[name](spark, SF_SMALL)).count("FileScan") == 1


def test_replay_shuffles_its_rows_once(spark):
    for name in ("late_row_audit", "monotone_event_time"):
        df = BATCH_QUERIES[name](spark, SF_SMALL)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("Initial Plan")[0]
        assert "ExistingRDD" not in final
        # one exchange of rows, one of the partial block maxima, one of the block maxima to their prefix window
        assert len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", final)) <= 3


def test_lenient_parse_tells_objects_from_other_text(spark):
    rows = ['{"ts":1}', '{"ts":"x","siteId":2}', "[1]", '[{"ts":1}]', "5", '"a"', "", None, "{", "{}", ' {"ts":3}', "null", "bad {}"]
    df = spark.createDataFrame([(r,) for r in rows], "value STRING")
    got = {r["value"]: (r["ts"], r["siteId"]) for r in parse_messages(df, schemas.ACCESS_LOG, lenient=True, keep=("value",)).collect()}
    assert got == {'{"ts":1}': (1, None), '{"ts":"x","siteId":2}': (None, 2), "{}": (None, None), ' {"ts":3}': (3, None)}
    assert parse_messages(df.limit(0), schemas.ACCESS_LOG).collect() == []


def test_strict_numbers_fail_without_ansi_too(spark):
    import pytest
    from pyspark.sql import functions as F

    from rill.functions.csv import parse_long
    from rill.functions.time import from_text, interval

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("1" * 20, "no time")], "n STRING, t STRING")
        for column in (parse_long("n"), from_text("t")):
            with pytest.raises(Exception, match="not a valid|unparseable"):
                df.select(column).collect()
        row = spark.range(1).select(F.lit("2024-01-01").cast("timestamp_ntz") + interval("1 min") + interval("1 h")).first()
        assert str(row[0]) == "2024-01-01 01:01:00"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_replay_plans_do_not_grow_with_the_shuffle_partitions(spark):
    """Building takes no literal per block: the plan is as long at 2,000 shuffle partitions as at 4."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name in ("late_row_audit", "monotone_event_time"):
            sizes = []
            for n in ("4", "2000"):
                spark.conf.set("spark.sql.shuffle.partitions", n)
                plan = optimized(BATCH_QUERIES[name](spark, SF_SMALL))
                sizes.append(len(re.sub(r"#\d+L?|\S*running_max-\S+", "", plan)))
            assert abs(sizes[0] - sizes[1]) <= 16, sizes
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
