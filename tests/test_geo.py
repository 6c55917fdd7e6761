import bisect
import random

import pytest
from pyspark.sql import functions as F

from flowtally.functions.addresses import octets, octets_number
from flowtally.operators import geo


def _brute(ends, ip):
    if ip is None:
        return "N/A"
    i = bisect.bisect_left([e for e, _ in ends], ip)
    return ends[i][1] if i < len(ends) else "N/A"


@pytest.fixture(scope="module")
def dense():
    """Ends crowded into few blocks, blocks without ends, and an uncovered top."""
    draw = random.Random(5)
    ends = {0, 65535, 65536, 2**31}
    ends |= {draw.randrange(0, 2**31) for _ in range(300)}
    ends |= {10 * 2**24 + draw.randrange(0, 2000) for _ in range(300)}
    return [(e, f"place{e}") for e in sorted(ends)]


@pytest.mark.parametrize("prefix_bits, strategy", [
    (8, "auto"), (16, "auto"), (16, "shuffle")])
def test_lookup_equals_brute_force(spark, dense, prefix_bits, strategy):
    draw = random.Random(7)
    ips = [draw.randrange(0, 2**32) for _ in range(400)]
    ips += [10 * 2**24 + draw.randrange(0, 2500) for _ in range(400)]
    ips += [e + d for e, _ in dense[:50] for d in (-1, 0, 1) if e + d >= 0]
    ips += [None, 0, 2**32 - 1] + [10 * 2**24 + 5] * 500
    probes = spark.createDataFrame(list(enumerate(ips)), "id int, ip bigint")
    ranges = spark.createDataFrame(dense, "ip_end bigint, location string")
    got = geo.lookup(probes, ranges, prefix_bits=prefix_bits, strategy=strategy).collect()
    assert len(got) == len(ips)
    assert {r["id"]: r["location"] for r in got} == {
        i: _brute(dense, ip) for i, ip in enumerate(ips)}


@pytest.mark.parametrize("bound", ["BROADCAST_ROWS", "BROADCAST_BYTES", "BROADCAST_CANDIDATES"])
def test_oversized_range_table_takes_the_other_way(spark, dense, monkeypatch, bound):
    monkeypatch.setattr(geo, bound, 10)
    ranges = spark.createDataFrame(dense, "ip_end bigint, location string")
    probes = spark.createDataFrame([(5,), (10 * 2**24 + 3,)], "ip bigint")
    found = geo.lookup(probes, ranges)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan
    assert {r["location"] for r in found.collect()} == {
        _brute(dense, 5), _brute(dense, 10 * 2**24 + 3)}


def test_address_text(spark):
    texts = ["0.0.0.0", "255.255.255.255", "10.0.0.1", "256.1.1.1", "1.2.3", "1.2.3.4.5", "a.b.c.d",
             "", None, "1.2.3.-4", " 1.2.3.4", "1.2.3.4\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    numbers = rows.withColumn("parts", octets(rows["t"])).withColumn(
        "n", octets_number(F.col("parts")))
    assert [r["n"] for r in numbers.collect()] == [0, 2**32 - 1, 167772161] + [None] * 9


def test_text_probes_and_empty_ranges(spark):
    probes = spark.createDataFrame([("1.2.3.4",), ("bad",)], "ip string")
    ranges = spark.createDataFrame([(2**24 * 2, "here")], "ip_end bigint, location string")
    assert {tuple(r) for r in geo.lookup(probes, ranges).collect()} == {
        ("1.2.3.4", "here"), ("bad", "N/A")}
    for strategy in ("auto", "shuffle"):
        none = geo.lookup(probes, ranges.filter("false"), strategy=strategy)
        assert {r["location"] for r in none.collect()} == {"N/A"}


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        geo.lookup(spark.range(1), spark.range(1), strategy="other")
