"""CSV metric lines: the Spark parse against a plain-Python model of the
producer's rules, on generated lines (one Spark job for all of them)."""

import random
import re

from rill.plans import jobs

INT = re.compile(r"^[+-]?[0-9]+$")
LONG_MIN, LONG_MAX = -(2 ** 63), 2 ** 63 - 1


def java_split(line: str) -> list[str]:
    """String.split(","): trailing empty strings are removed."""
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def parse_long(text):
    if text is None or not INT.match(text):
        return None
    v = int(text)
    return v if LONG_MIN <= v <= LONG_MAX else None


def model(line):
    """(host, mem, event_ms) in lenient mode, or None when the line drops."""
    if line is None or "," not in line:
        return None
    p = java_split(line)
    get = lambda i: p[i] if i < len(p) else None
    return (get(1), parse_long(get(2)), parse_long(get(0)))


def _line(rnd: random.Random) -> str:
    alphabet = "0123456789,, -+ab"
    n = rnd.randint(0, 12)
    s = "".join(rnd.choice(alphabet) for _ in range(n))
    if rnd.random() < 0.3:
        s = f"{rnd.randint(-10**6, 10**6)},h{rnd.randint(0, 9)},{rnd.randint(0, 10**4)}"
    if rnd.random() < 0.05:
        s = f"{10**20},h,1"  # does not fit in a long
    return s


def test_lenient_parse_matches_model(spark):
    rnd = random.Random(7)
    lines = [_line(rnd) for _ in range(2000)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "id INT, value STRING")
    got = {r["id"]: (r["host"], r["mem"], r["event_ms"])
           for r in jobs.host_mem(df, lenient=True, keep=("id",)).collect()}
    want = {i: model(v) for i, v in enumerate(lines) if model(v) is not None}
    assert got == want


def test_strict_parse_matches_model_on_valid_lines(spark):
    import pytest
    from pyspark.errors import PySparkException

    rnd = random.Random(11)
    lines = [_line(rnd) for _ in range(2000)]
    valid = [v for v in lines if model(v) is not None and None not in model(v)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(valid)], "id INT, value STRING")
    got = {r["id"]: (r["host"], r["mem"], r["event_ms"]) for r in jobs.host_mem(df, keep=("id",)).collect()}
    assert got == {i: model(v) for i, v in enumerate(valid)}
    bad = [v for v in lines if model(v) is not None and model(v)[0] is not None and model(v)[1] is None]
    assert bad
    with pytest.raises(PySparkException):
        jobs.host_mem(spark.createDataFrame([(bad[0],)], "value STRING")).collect()
