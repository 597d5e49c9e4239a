"""Exact grouped quantiles whose cost does not depend on the size of a group.

The built-in exact percentile holds every distinct value of a group in one task. Here a group is
first reduced to a histogram of logarithmic buckets, on the map side, so that a group holding a
third of all rows costs no more than any other. The histogram tells which bucket holds the wanted
ranks; the smallest and the largest value of a bucket are known, which settles most groups at once.
For the rest that one bucket is cut into equal slots, again by a hash aggregation, until the wanted
ranks are settled: each pass narrows the range a thousandfold, and no task ever holds the values of a
bucket.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.session import written

# Buckets per factor of e, about 0.1 % wide each: fine enough that a bucket holds a thousandth of a
# large group, coarse enough that a map task sends few buckets.
RESOLUTION = 1024
# Equal slots into which a pass cuts an open range.
SLOTS = 1024
# ln of the smallest double is above -746: keeps the bucket numbers of positive values positive.
_SHIFT = 750 * RESOLUTION


@dataclass
class Quantile:
    """Quantile ``p`` of ``value`` over the rows where ``when`` holds."""

    p: float = 0.5
    when: Column | None = None


@dataclass
class Summary:
    """What to compute per group: quantiles of one value, counts of rows, means of columns.

    With ``weight`` a row stands for that many rows of equal value; a mean is then given as the sum over
    these rows and their number.
    """

    value: Column
    quantiles: dict[str, Quantile]
    counts: dict[str, Column | None] = field(default_factory=dict)
    means: dict[str, Column | tuple[Column, Column]] = field(default_factory=dict)
    sums: dict[str, Column] = field(default_factory=dict)
    weight: Column | None = None


def bucket_of(value: Column) -> Column:
    """Bucket number of a finite double; never decreases as the value grows."""
    size = (F.floor(F.log(F.abs(value)) * F.lit(float(RESOLUTION))) + F.lit(_SHIFT)).cast("int")
    return F.when(value > 0, size).when(value < 0, -size).when(value == 0, F.lit(0))


def _ranks(total: Column, p: float) -> tuple[Column, Column, Column]:
    """Lower rank, upper rank (from 1) and the weight of the upper one."""
    position = (total - F.lit(1)) * F.lit(p)
    low = F.floor(position)
    return low + F.lit(1), F.ceil(position) + F.lit(1), position - low


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def _histogram(rows: DataFrame, by: list[str], spec: Summary, names: list[str]) -> DataFrame:
    aggs = []
    for m in names:
        aggs += [
            F.coalesce(F.sum(F.when(F.col(f"v_{m}").isNotNull(), F.col("_w"))), F.lit(0)).alias(f"n_{m}")
            if spec.weight is not None else F.count(f"v_{m}").alias(f"n_{m}"),
            F.min(f"v_{m}").alias(f"min_{m}"),
            F.max(f"v_{m}").alias(f"max_{m}"),
        ]
    aggs += [F.sum(f"c_{c}").alias(f"c_{c}") for c in spec.counts]
    aggs += [F.sum(f"s_{c}").alias(f"s_{c}") for c in spec.sums]
    for c in spec.means:
        n = F.sum(f"k_{c}") if spec.weight is not None else F.count(f"m_{c}")
        aggs += [F.sum(f"m_{c}").alias(f"ms_{c}"), n.alias(f"mn_{c}")]
    return rows.groupBy(*by, "_bucket").agg(*aggs)


def _rows(df: DataFrame, by: list[str], spec: Summary) -> DataFrame:
    """Only the columns needed: keys, bucket, the value under each condition, other measures."""
    value = spec.value.cast("double")
    columns = [bucket_of(value).alias("_bucket")]
    if spec.weight is not None:
        columns.append(spec.weight.cast("bigint").alias("_w"))
    for m, q in spec.quantiles.items():
        columns.append((value if q.when is None else F.when(q.when, value)).alias(f"v_{m}"))
    for c, cond in spec.counts.items():
        one = F.lit(1) if spec.weight is None else spec.weight
        one = one if cond is None else F.when(cond, one).otherwise(F.lit(0))
        columns.append(one.cast("bigint").alias(f"c_{c}"))
    for name, c in spec.means.items():
        total, n = (c, None) if spec.weight is None else c
        columns.append(total.cast("double").alias(f"m_{name}"))
        if n is not None:
            columns.append(n.alias(f"k_{name}"))
    columns += [c.alias(f"s_{name}") for name, c in spec.sums.items()]
    return df.select(*by, *columns)


def _locate(hist: DataFrame, by: list[str], spec: Summary) -> DataFrame:
    """Per group: the bucket of each wanted rank, the rank inside it, and the value if settled."""
    group = Window.partitionBy(*by)
    running = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = {}
    for m in spec.quantiles:
        steps[f"cum_{m}"] = F.sum(f"n_{m}").over(running)
        steps[f"tot_{m}"] = F.sum(f"n_{m}").over(group)
    ranked = hist.withColumns(steps)
    aggs = [F.sum(f"c_{c}").alias(f"c_{c}") for c in spec.counts]
    aggs += [F.sum(f"s_{c}").alias(f"s_{c}") for c in spec.sums]
    for c in spec.means:
        aggs.append((F.sum(f"ms_{c}") / F.nullif(F.sum(f"mn_{c}"), F.lit(0))).alias(f"m_{c}"))
    for m, q in spec.quantiles.items():
        total, n, before = F.col(f"tot_{m}"), F.col(f"n_{m}"), F.col(f"cum_{m}") - F.col(f"n_{m}")
        low, high, weight = _ranks(total, q.p)
        aggs.append(F.max(F.when(total > 0, weight)).alias(f"w_{m}"))
        for side, rank in (("lo", low), ("hi", high)):
            inside = rank - before
            here = (inside >= 1) & (inside <= n)
            least, most = F.col(f"min_{m}"), F.col(f"max_{m}")
            settled = F.when((inside == 1) | (least == most), least).when(inside == n, most)
            aggs += [
                F.max(F.when(here, F.col("_bucket"))).alias(f"b_{side}_{m}"),
                F.max(F.when(here, inside)).alias(f"r_{side}_{m}"),
                F.max(F.when(here, settled)).alias(f"x_{side}_{m}"),
                F.max(F.when(here, least)).alias(f"least_{side}_{m}"),
                F.max(F.when(here, most)).alias(f"most_{side}_{m}"),
            ]
    return ranked.groupBy(*by).agg(*aggs)


def _is_open(m: str) -> Column:
    """The histogram found where a quantile lies, but not its value."""
    unsettled = F.col(f"x_lo_{m}").isNull() | F.col(f"x_hi_{m}").isNull()
    return F.col(f"r_lo_{m}").isNotNull() & unsettled


def _open_ranges(located: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """The quantiles that the histogram left open: their bucket and its bounds, ranks within it.

    Both ranks of a quantile are neighbours: if they lie in two buckets, they are the last value of
    one and the first of the next, and settled. So an open quantile has one bucket.
    """
    cases = []
    for i, m in enumerate(names):
        side = F.when(F.col(f"x_lo_{m}").isNull(), F.lit("lo")).otherwise(F.lit("hi"))
        cases.append(F.when(_is_open(m), F.struct(
            F.lit(i).alias("_m"),
            *(F.when(side == "lo", F.col(f"{c}_lo_{m}")).otherwise(F.col(f"{c}_hi_{m}")).alias(n)
              for c, n in (("b", "_bucket"), ("least", "_least"), ("most", "_most"))),
            F.when(F.col(f"x_lo_{m}").isNull(), F.col(f"r_lo_{m}")).alias("_lo"),
            F.when(F.col(f"x_hi_{m}").isNull(), F.col(f"r_hi_{m}")).alias("_hi"),
        )))
    return located.where("_open").select(
        *by, F.explode(F.array_compact(F.array(*cases))).alias("_t")).select(*by, "_t.*")


def _inside(rows: DataFrame, ranges: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """The values inside open ranges, one row for each range that a value lies in."""
    # No broadcast hint: the ranges are stored, so their real size decides the join.
    joined = rows.join(ranges, _same(rows, ranges, [*by, "_bucket"]))
    value = F.when(F.lit(False), F.lit(None).cast("double"))
    for i, m in enumerate(names):
        value = value.when(F.col("_m") == i, F.col(f"v_{m}"))
    weight = F.col("_w") if "_w" in rows.columns else F.lit(1).cast("bigint")
    return joined.select(
        *(ranges[k].alias(k) for k in by), "_m", value.alias("_x"), weight.alias("_w"),
        "_lo", "_hi", "_least", "_most",
    ).where(F.col("_x").between(F.col("_least"), F.col("_most")))


def _narrowed(inside: DataFrame, by: list[str]) -> DataFrame:
    """One pass: values of the ranks that it settles, narrower ranges for the others."""
    # Halved before the difference, which could exceed the largest double.
    part = (F.col("_x") / 2 - F.col("_least") / 2) / (F.col("_most") / 2 - F.col("_least") / 2)
    slot = F.least(F.lit(SLOTS - 1), F.floor(part * SLOTS))
    key = [*by, "_m", "_lo", "_hi"]
    slots = inside.groupBy(*key, slot.alias("_slot")).agg(
        F.sum("_w").alias("_n"), F.min("_x").alias("_least"), F.max("_x").alias("_most"))
    before = F.coalesce(F.sum("_n").over(
        Window.partitionBy(*by, "_m").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = slots.withColumn("_before", before)
    aggs = []
    for side in ("lo", "hi"):
        rank = F.col(f"_{side}") - F.col("_before")
        here = (rank >= 1) & (rank <= F.col("_n"))
        least, most = F.col("_least"), F.col("_most")
        settled = F.when((rank == 1) | (least == most), least).when(rank == F.col("_n"), most)
        aggs += [F.max(F.when(here, settled)).alias(f"_y_{side}"),
                 F.max(F.when(here & settled.isNull(), F.struct(rank.alias("r"), "_least", "_most"))).alias(f"_o_{side}")]
    return ranked.groupBy(*key).agg(*aggs)


def _refined(rows: DataFrame, ranges: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Values at the open ranks, one row per group: ``y_lo_m`` and ``y_hi_m`` for each quantile m.

    The values inside open ranges, about a thousandth of a large group, are written once; the passes
    read those, not the input.
    """
    inside = survivors = written(_inside(rows, ranges, by, names), "open", even=True)
    found = []
    while True:
        passed = written(_narrowed(inside, by), "pass", even=True)
        found.append(passed.select(*by, "_m", "_y_lo", "_y_hi"))
        left = passed.where("_o_lo is not null or _o_hi is not null")
        if left.isEmpty():
            break
        bounds = F.coalesce("_o_lo", "_o_hi")
        ranges = left.select(
            *by, "_m", bounds["_least"].alias("_least"), bounds["_most"].alias("_most"),
            F.col("_o_lo.r").alias("_lo"), F.col("_o_hi.r").alias("_hi"))
        values = survivors.select(*by, "_m", "_x", "_w")
        on = _same(values, ranges, [*by, "_m"]) & F.col("_x").between(F.col("_least"), F.col("_most"))
        inside = values.join(ranges, on).select(
            *(values[c] for c in (*by, "_m")), "_x", "_w", "_lo", "_hi", "_least", "_most")
    picks = [
        F.max(F.when(F.col("_m") == i, F.col(f"_y_{side}"))).alias(f"y_{side}_{m}")
        for i, m in enumerate(names) for side in ("lo", "hi")
    ]
    return reduce(DataFrame.unionByName, found).groupBy(*by).agg(*picks)


def summarise(df: DataFrame, by: list[str], spec: Summary) -> DataFrame:
    """``by``, the counts, means and sums, and the exact quantiles (NULL where no value counts).

    NULL is an ordinary group. Runs one job for the histogram and, if it leaves ranges open, one that
    writes the values inside them; these two read the input, so it should be a stored table.
    """
    names = list(spec.quantiles)
    rows = _rows(df, by, spec)
    hist = _histogram(rows, by, spec, names)
    any_open = reduce(lambda a, b: a | b, (_is_open(m) for m in names))
    located = written(_locate(hist, by, spec).withColumn("_open", any_open), "quantiles", split_by="_open", even=True)
    ranges = _open_ranges(located, by, names)
    out = located
    if not ranges.isEmpty():
        refined = _refined(rows, ranges, by, names)
        kept = [c for c in refined.columns if c not in by]
        out = located.join(refined, _same(located, refined, by), "left").select(located["*"], *kept)
    columns = [F.col(k) for k in by]
    for m in names:
        low, high, weight = F.col(f"x_lo_{m}"), F.col(f"x_hi_{m}"), F.col(f"w_{m}")
        if out is not located:
            low, high = F.coalesce(low, f"y_lo_{m}"), F.coalesce(high, f"y_hi_{m}")
        blended = (F.lit(1.0) - weight) * low + weight * high
        columns.append(F.when(weight == 0, low).otherwise(blended).alias(m))
    columns += [F.col(f"c_{c}").alias(c) for c in spec.counts]
    columns += [F.col(f"m_{c}").alias(c) for c in spec.means]
    columns += [F.col(f"s_{c}").alias(c) for c in spec.sums]
    return out.select(*columns)


def grouped_median(df: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
    return summarise(df, by, Summary(value, {name: Quantile()}))
