"""The job runner on recorded messages (files instead of a topic)."""

from paths_for_tests import SF_SMALL

from rill.__main__ import main
from rill.plans import jobs
from rill.sources import replay
from rill.sources.tables import read_table


def _record(spark, topic_fn, folder):
    topic_fn(read_table(spark, SF_SMALL, "events")).select("value").write.mode("overwrite").text(folder)


def test_access_log_job_from_files(spark, tmp_dir):
    _record(spark, replay.access_log_topic, f"{tmp_dir}/msgs")
    main(["access-log", "--path", f"{tmp_dir}/msgs", "--database", "rill_main", "--table", "log_a",
          "--checkpoint", f"{tmp_dir}/ck", "--available-now"])
    table = spark.table("rill_main.log_a")
    committed = table.count()
    expected = jobs.access_log_rows(replay.access_log_records(read_table(spark, SF_SMALL, "events"))).count()
    assert 0 < committed <= expected   # only partitions behind the watermark are published


def test_url_summary_job_from_files(spark, tmp_dir):
    _record(spark, replay.metric_topic, f"{tmp_dir}/msgs")
    main(["url-summary", "--path", f"{tmp_dir}/msgs", "--sink-path", f"{tmp_dir}/out",
          "--checkpoint", f"{tmp_dir}/ck", "--available-now"])
    lines = [r[0] for r in spark.read.text(f"{tmp_dir}/out").collect()]
    assert lines and all(l.startswith('{"f0":"') for l in lines)


def test_url_counts_and_monotone_time_jobs(spark, tmp_dir, capsys):
    """Recorded metrics need a record time only where it is asked for; totals go on over two runs."""
    events = read_table(spark, SF_SMALL, "events")
    replay.metric_topic(events).select("value", "partition", "offset", "timestamp").write.parquet(f"{tmp_dir}/msgs")
    for _ in range(2):
        main(["url-counts", "--path", f"{tmp_dir}/msgs", "--format", "parquet", "--database", "rill_main", "--table", "urls_a",
              "--late-table", "urls_late", "--checkpoint", f"{tmp_dir}/ck", "--available-now"])
        assert f"rows {events.count()}" in capsys.readouterr().err
    assert 0 < spark.table("rill_main.urls_a").count() <= events.count() and spark.table("rill_main.urls_late").count() == 0
    main(["monotone-time", "--path", f"{tmp_dir}/msgs", "--format", "parquet", "--database", "rill_main", "--table", "mono_a",
          "--checkpoint", f"{tmp_dir}/ck2", "--available-now"])
    assert spark.table("rill_main.mono_a").where("monotone_ts >= payload_time").count() == events.count()


def test_tracked_urls_from_parquet(spark, tmp_dir):
    main(["tracked-urls", "--path", f"{SF_SMALL}/pages.parquet", "--format", "parquet",
          "--sink-path", f"{tmp_dir}/urls"])
    got = spark.read.parquet(f"{tmp_dir}/urls")
    assert got.columns == ["url"]
    assert got.count() == read_table(spark, SF_SMALL, "pages").count()


def test_all_tracked_urls_are_printed(spark, capsys):
    main(["tracked-urls", "--path", f"{SF_SMALL}/pages.parquet", "--format", "parquet"])
    printed = [x for x in capsys.readouterr().out.splitlines() if x.startswith("http")]
    assert len(printed) == read_table(spark, SF_SMALL, "pages").count() > 20


JOB_SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from rill.__main__ import main
from pyspark.sql import SparkSession
SparkSession.builder.master("local[2]").config("spark.sql.warehouse.dir", {base!r} + "/wh").config(
    "spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
main(sys.argv[1:])
"""


def test_restarted_jobs_resume_from_the_default_checkpoint(spark, tmp_dir):
    """Two runs in two sessions over a growing folder equal one run over all of it."""
    import subprocess
    import sys

    from paths_for_tests import ROOT
    from pyspark.sql import functions as F

    messages = replay.metric_topic(read_table(spark, SF_SMALL, "events")).select("value", F.col("offset")).orderBy("offset")
    first, second = messages.where("offset < 500"), messages.where("offset >= 500")

    def job(base, *more):
        script = JOB_SCRIPT.format(root=ROOT, base=base)
        args = ["url-summary", "--path", f"{base}/msgs", "--sink-path", f"{base}/out", "--available-now",
                "--shared-dir", f"{base}/shared", *more]
        done = subprocess.run([sys.executable, "-c", script, *args], capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]

    two, one = f"{tmp_dir}/two", f"{tmp_dir}/one"
    first.select("value").coalesce(1).write.text(f"{two}/msgs")
    job(two)
    before = spark.read.text(f"{two}/out").count()
    second.select("value").coalesce(1).write.mode("append").text(f"{two}/msgs")
    job(two)
    messages.select("value").coalesce(1).write.text(f"{one}/msgs")
    job(one)
    got = sorted(r[0] for r in spark.read.text(f"{two}/out").collect())
    assert before < len(got) and got == sorted(r[0] for r in spark.read.text(f"{one}/out").collect())


def test_checkpoint_names(spark):
    from rill.session import job_checkpoint

    a, b = (job_checkpoint(spark, "access-log", s) for s in ("`db`.`a`", "`db`.`b`"))
    assert a != b and a == job_checkpoint(spark, "access-log", "`db`.`a`") and "/access-log/" in a
