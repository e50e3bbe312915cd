"""JSON and CSV message parsing: strict and lenient modes."""

import pytest
from pyspark.errors import PySparkException

from rill import schemas
from rill.functions import csv as csvf
from rill.functions.json import is_json_object, parse_messages, tuple_json
from rill.plans import jobs

FULL = (
    '{"name":"mem","timestamp":1000,"url":"u","fields":{"used_percent":90.0,"init":900},'
    '"tags":{"cluster":"c"}}'
)


def _values(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id INT, value STRING")


def test_strict_json_raises_on_bad_message(spark):
    df = _values(spark, [FULL, "not json"])
    with pytest.raises(Exception) as exc:
        parse_messages(df, schemas.METRIC, keep=("id",)).collect()
    assert "MALFORMED" in str(exc.value).upper()


def test_lenient_json_keeps_objects_only(spark):
    df = _values(spark, [FULL, "not json", '{"name":1,"timestamp":"x"}', None, '{"name":"q"}'])
    out = {r["id"]: r for r in parse_messages(df, schemas.METRIC, lenient=True, keep=("id",)).collect()}
    assert sorted(out) == [0, 2, 4]
    assert out[2]["name"] == "1" and out[2]["timestamp"] is None
    assert out[4]["name"] == "q" and out[4]["fields"] is None and out[4]["url"] is None


def test_json_object_check(spark):
    df = _values(spark, ['{"a":1}', "5", "[1]", "not json", None, "{broken"])
    got = [r[0] for r in df.orderBy("id").select(is_json_object("value")).collect()]
    assert got[0] is True
    assert not any(got[1:])


def test_map_keeps_number_text(spark):
    df = _values(spark, [FULL])
    row = parse_messages(df, schemas.METRIC).collect()[0]
    assert row["fields"] == {"used_percent": "90.0", "init": "900"}


def test_tuple_json_text(spark):
    df = spark.createDataFrame([("u", 3), (None, 1)], "url STRING, cnt BIGINT")
    got = [r[0] for r in df.select(tuple_json("url", "cnt")).collect()]
    assert got == ['{"f0":"u","f1":3}', '{"f1":1}']
    kept = [r[0] for r in df.select(tuple_json("url", "cnt", keep_nulls=True)).collect()]
    assert kept[1] == '{"f0":null,"f1":1}'


def test_csv_lines_lenient(spark):
    df = _values(spark, ["1,h,10", "1,h", "nocomma", None, "1,h, 12", "5,h,7,,"])
    out = {r["id"]: r for r in jobs.host_mem(df, lenient=True, keep=("id",)).collect()}
    assert sorted(out) == [0, 1, 4, 5]  # no-comma and NULL lines drop
    assert (out[0]["host"], out[0]["mem"], out[0]["event_ms"]) == ("h", 10, 1)
    assert out[1]["mem"] is None
    assert out[4]["mem"] is None  # spaces are not a number
    assert out[5]["mem"] == 7  # trailing empty items are dropped


@pytest.mark.parametrize("line", ["1,h", "1,h, 12", "x,h,1"])
def test_csv_strict_rejects(spark, line):
    df = _values(spark, [line])
    with pytest.raises(PySparkException):
        jobs.host_mem(df).collect()


def test_event_millis_zero_without_comma(spark):
    df = _values(spark, ["nocomma", "42,h,1"])
    got = [r[0] for r in df.orderBy("id").select(csvf.line_event_millis("value")).collect()]
    assert got == [0, 42]


def test_fail_on_missing_field(spark):
    from rill.functions.json import require_fields

    df = _values(spark, ['{"name":"a","url":"u"}', '{"name":"b"}'])
    parsed = parse_messages(df, schemas.METRIC)
    assert require_fields(parsed.where("name = 'a'"), ["name", "url"]).count() == 1
    with pytest.raises(PySparkException):
        require_fields(parsed, ["name", "url"]).collect()


def test_processing_time_and_schema(spark, capsys):
    from rill.functions.time import processing_time
    from rill.plans.catalog import print_schema

    df = _values(spark, ["x"]).withColumn("procTime", processing_time())
    assert dict(df.dtypes)["procTime"] == "timestamp"
    print_schema(df)
    assert "procTime" in capsys.readouterr().out


def test_file_topic_source(spark, tmp_dir):
    """Recorded messages as text files go through the same parse."""
    from rill.sources.messages import read_messages

    with open(f"{tmp_dir}/part-0.txt", "w") as f:
        f.write(FULL + "\n" + '{"name":"x","url":"v","timestamp":5}\n')
    batch = read_messages(spark, "text", stream=False, path=tmp_dir)
    rows = parse_messages(batch, schemas.METRIC).orderBy("name").collect()
    assert [(r["name"], r["url"]) for r in rows] == [("mem", "u"), ("x", "v")]
    stream = read_messages(spark, "text", stream=True, path=tmp_dir)
    assert stream.isStreaming and "value" in stream.columns
