"""Driver contract: entry smoke run, registry consistency, oracle checks."""

import pytest

import __spark_entry__ as entry_mod
from oracle_compare import compare, duck

FAST = [
    "site_count_20s", "url_count_json", "metric_json_parse", "event_time_from_string",
    "event_time_from_epoch", "access_log_etl", "partitions_ready", "csv_metric_split",
    "host_mem_mean_2s", "late_row_audit", "monotone_event_time", "pv_per_user_1m",
    "product_like_sum", "product_like_rows", "tracked_urls", "site_count_20s_stream",
    "url_count_5s_stream", "text_sink_roundtrip", "hourly_partitions_ready",
    "site_count_20s_sql", "product_like_sum_stream", "url_count_2s", "product_like_files",
    "site_count_20s_table", "order_copy_stream", "pv_per_user_1m_stream",
    "access_log_hive_stream", "access_log_committed", "hourly_order_committed",
    "host_mem_median_1d", "late_rows_stream", "url_count_two_clocks_stream", "monotone_event_time_stream",
    "product_sum_by_brand_stream", "url_count_5s_rocksdb_stream", "event_time_totals_stream",
]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["url", "access_count", "start_time", "end_time"]


def test_every_query_has_oracle():
    from rill.plans.registry import QUERIES

    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(QUERIES) <= set(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def con():
    from paths_for_tests import SF_SMALL

    return duck(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    from paths_for_tests import SF_SMALL

    res = compare(spark, name, SF_SMALL, con)
    assert res["status"] == "match", res


def test_stream_equals_batch_on_closed_windows(spark):
    """Streaming with availableNow equals the batch query restricted to the
    windows the final watermark closed (window_end <= max time - delay)."""
    from pyspark.sql import functions as F

    from paths_for_tests import SF_SMALL
    from rill.sources import replay
    from rill.sources.tables import read_table
    from rill.functions.time import from_text

    batch = entry_mod.queries()["site_count_20s"](spark, SF_SMALL)
    stream = entry_mod.queries()["site_count_20s_stream"](spark, SF_SMALL)
    recs = replay.access_log_text_records(read_table(spark, SF_SMALL, "events"))
    wm = recs.select(F.max(from_text("logTime")) - F.expr("INTERVAL 15 SECONDS")).collect()[0][0]
    closed = batch.where(F.col("end_time") <= F.lit(wm))
    assert closed.count() == stream.count()
    assert closed.exceptAll(stream).count() == 0 and stream.exceptAll(closed).count() == 0
