"""Exact quantiles against the built-in percentile and brute force."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrier.operators.quantiles import Quantile, Summary, bucket_of, grouped_median, summarise


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v double, c int")


def _medians(df):
    return {r.g: r.m for r in df.collect()}


def test_two_values_are_averaged(spark):
    df = _frame(spark, [("a", 1.0, 0), ("a", 4.0, 0)])
    assert _medians(grouped_median(df, ["g"], F.col("v"), "m")) == {"a": 2.5}


def test_group_without_values_is_null_and_null_is_a_group(spark):
    df = _frame(spark, [("a", None, 0), (None, 3.0, 0), (None, 5.0, 0), (None, 9.0, 0)])
    assert _medians(grouped_median(df, ["g"], F.col("v"), "m")) == {"a": None, None: 5.0}


@pytest.mark.parametrize("p", [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0])
def test_equals_builtin_percentile_on_crowded_buckets(spark, p):
    """Values so close that thousands share a bucket, a hot group and a hot value."""
    rnd = random.Random(7)
    rows = [("hot", 2000 + rnd.random() / 100, i % 3) for i in range(20000)]
    rows += [("hot", 2000.005, 0)] * 20000
    rows += [(f"g{i % 40}", round(rnd.lognormvariate(7, 1), 2), i % 3) for i in range(4000)]
    rows += [("signs", rnd.uniform(-5, 5), i % 3) for i in range(999)] + [("signs", 0.0, 1)] * 30
    df = _frame(spark, rows).repartition(8)
    cond = F.col("c") == 1
    spec = Summary(F.col("v"), {"m": Quantile(p), "k": Quantile(p, cond)}, {"n": None, "nc": cond})
    got = {r.g: (r.m, r.k, r.n, r.nc) for r in summarise(df, ["g"], spec).collect()}
    want = {
        r.g: (r.m, r.k, r.n, r.nc)
        for r in df.groupBy("g").agg(
            F.percentile("v", F.lit(p)).alias("m"),
            F.percentile(F.when(cond, F.col("v")), F.lit(p)).alias("k"),
            F.count(F.lit(1)).alias("n"), F.count_if(cond).alias("nc"),
        ).collect()
    }
    assert got.keys() == want.keys()
    for g in want:
        assert got[g][2:] == want[g][2:]
        for a, b in zip(got[g][:2], want[g][:2]):
            assert a == pytest.approx(b, rel=1e-15)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6, allow_subnormal=False)),
        min_size=1, max_size=60,
    )
)
def test_median_property(spark, rows):
    df = _frame(spark, [(g, v, 0) for g, v in rows])
    got = _medians(grouped_median(df, ["g"], F.col("v"), "m"))
    want = {g: statistics.median(v for k, v in rows if k == g) for g in {g for g, _ in rows}}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-300) for g in want)


def test_buckets_keep_the_order_of_values(spark):
    rnd = random.Random(3)
    values = sorted(
        [rnd.uniform(-1, 1) * 10 ** rnd.randint(-300, 300) for _ in range(5000)]
        + [0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]
    )
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r[0] for r in df.select(bucket_of(F.col("v"))).collect()]
    assert None not in found and found == sorted(found)


def test_many_values_in_one_bucket(spark):
    """Ten million distinct values within 0.05 %: settled by passes over slots, in many tasks."""
    n = 10_000_000
    df = spark.range(n, numPartitions=8).select(
        F.lit("a").alias("g"), (1.0 + F.col("id") * 5e-11).alias("v"), F.lit(0).alias("c"))
    spec = Summary(F.col("v"), {"m": Quantile(), "q": Quantile(0.25)}, counts={"n": None})
    row = summarise(df, ["g"], spec).collect()[0]
    assert row.n == n
    assert row.m == pytest.approx(1.0 + (n - 1) / 2 * 5e-11, abs=1e-13)
    assert row.q == pytest.approx(1.0 + (n - 1) / 4 * 5e-11, abs=1e-13)


def test_weighted_rows_count_as_often_as_their_weight(spark):
    """Rows with counts against the same rows written out, with close values and several passes."""
    chance = random.Random(4)
    rows = [(f"g{chance.randrange(4)}", 100 + chance.randrange(400) * 1e-9, chance.randrange(1, 5))
            for _ in range(3000)] + [("hot", 5.0 + i * 1e-13, 3) for i in range(2000)]
    rows += [("none", None, 2)]
    spec = Summary(F.col("v"), {"m": Quantile(), "q": Quantile(0.3, F.col("c") > 2)}, {"n": None},
                   {"a": (F.col("v") * F.col("c"), F.when(F.col("v").isNotNull(), F.col("c")))}, weight=F.col("c"))
    got = {r.g: r for r in summarise(_frame(spark, rows), ["g"], spec).collect()}
    for g in {g for g, _, _ in rows}:
        own = sorted(v for k, v, c in rows if k == g and v is not None for _ in range(c))
        some = sorted(v for k, v, c in rows if k == g and v is not None and c > 2 for _ in range(c))
        assert got[g].n == sum(c for k, _, c in rows if k == g)
        assert got[g].m == (statistics.median(own) if own else None)
        assert got[g].a == (pytest.approx(statistics.fmean(own)) if own else None)
        if some:
            low = 0.3 * (len(some) - 1)
            at, part = int(low), low - int(low)
            assert got[g].q == pytest.approx(some[at] * (1 - part) + some[min(at + 1, len(some) - 1)] * part, rel=1e-15)
        else:
            assert got[g].q is None


def test_passes_read_the_written_values_only(spark, monkeypatch):
    """However many passes a group needs, the input is read for the histogram and the open values."""
    from terrier.operators import quantiles

    monkeypatch.setattr(quantiles, "SLOTS", 2)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = _frame(spark, [("a", 1 + i * 1e-9, 0) for i in range(1000)]).mapInArrow(counted, "g string, v double, c int")
    assert _medians(grouped_median(df, ["g"], F.col("v"), "m")) == {"a": pytest.approx(1 + 499.5e-9, rel=1e-15)}
    assert read.value == 2000
