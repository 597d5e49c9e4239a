"""Layouts of stored tables: space-filling order and buckets."""

import random

from pyspark.sql import functions as F

from terrier.operators import geo, morton
from terrier.sources import buckets
from test_plans import plan


def test_keys_interleave_column_and_row(spark):
    places = [(0.0, 0.0), (99.9, 0.0), (100.0, 0.0), (0.0, 100.0), (250.0, -1.0), (1e12, -1e12)]
    df = spark.createDataFrame([*places, (None, 1.0)], "x double, y double")
    got = [r.k for r in df.select(morton.morton(F.col("x"), F.col("y"), 100).alias("k")).collect()]
    middle = 1 << (morton.BITS - 1)
    clip = lambda v: max(0, min(2 * middle - 1, int(v // 100) + middle))
    assert got[:-1] == [morton._key(clip(x), clip(y)) for x, y in places] and got[-1] is None


def test_ranges_hold_the_box_and_little_else():
    chance = random.Random(3)
    for _ in range(200):
        x0, y0 = chance.uniform(-5000, 5000), chance.uniform(-5000, 5000)
        x1, y1 = x0 + chance.uniform(0, 4000), y0 + chance.uniform(0, 4000)
        ranges = morton.box_ranges(x0, y0, x1, y1, 10)
        assert len(ranges) <= 33 and all(a <= b for a, b in ranges)
        middle = 1 << (morton.BITS - 1)
        for _ in range(30):
            x, y = chance.uniform(x0, x1), chance.uniform(y0, y1)
            key = morton._key(int(x // 10) + middle, int(y // 10) + middle)
            assert any(a <= key <= b for a, b in ranges)
        squares = ((x1 - x0) / 10 + 2) * ((y1 - y0) / 10 + 2)
        assert sum(b - a + 1 for a, b in ranges) <= 6 * squares + 64


def test_a_smaller_radius_reads_fewer_files(spark, tmp_path):
    chance = random.Random(8)
    rows = [(i, chance.uniform(0, 64_000), chance.uniform(0, 64_000)) for i in range(4000)] + [(-1, None, 5.0), (-2, None, None)]
    rows += [(10_000 + i, 32_000.0, 32_000.0) for i in range(3000)]  # a hot place
    df = spark.createDataFrame(rows, "i long, X_LAMBERT93 double, Y_LAMBERT93 double")
    stored = morton.store_by_place(df, str(tmp_path / "t"), 100, 6)
    assert stored.count() == len(rows)
    read = {}
    for radius in (500.0, 6000.0, 20_000.0):
        box = (40_000 - radius, 20_000 - radius, 40_000 + radius, 20_000 + radius)
        near = morton.in_box(stored, *box, 100, 6)
        found = {r.i for r in geo.within_radius(near, 40_000.0, 20_000.0, radius).collect()}
        assert found == {r.i for r in geo.within_radius(df, 40_000.0, 20_000.0, radius).collect()}
        read[radius] = near.select(F.input_file_name().alias("f")).distinct().count()
        assert "PartitionFilters: [isnotnull(PLACE" in plan(near) or "PLACE#" in plan(near).split("PartitionFilters")[1]
    folders = {f.rsplit("/", 2)[1] for f in stored.inputFiles()}
    assert read[500.0] <= 4 < read[6000.0] < read[20_000.0] < len(folders)


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    chance = random.Random(1)
    sales = spark.createDataFrame([(f"a{chance.randrange(50)}", i, 2000 + i % 3) for i in range(500)], "ADDRESS_ID string, n int, ANNEE int")
    places = spark.createDataFrame([(f"a{i}", float(i)) for i in range(40)], "ADDRESS_ID string, x double")
    left = buckets.store_bucketed(sales, "b_sales", str(tmp_path / "s"), "ADDRESS_ID", 8, ["ANNEE"])
    right = buckets.store_bucketed(places, "b_places", str(tmp_path / "p"), "ADDRESS_ID", 8)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        for how in ("inner", "left_anti", "left"):
            joined = left.join(right, "ADDRESS_ID", how)
            assert "Exchange" not in plan(joined).split("\n\n")[0]
            assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, sales.join(places, "ADDRESS_ID", how).collect()), key=str)
        # Another session declares the stored tables and joins them in place as well.
        other = spark.newSession()
        other.conf.set(threshold, "-1")
        again = buckets.open_bucketed(other, "c_sales", str(tmp_path / "s"), left.schema, "ADDRESS_ID", 8, ["ANNEE"])
        same = buckets.open_bucketed(other, "c_places", str(tmp_path / "p"), right.schema, "ADDRESS_ID", 8)
        joined = again.join(same, "ADDRESS_ID")
        assert "Exchange" not in plan(joined).split("\n\n")[0] and joined.count() == left.join(right, "ADDRESS_ID").count()
    finally:
        spark.conf.set(threshold, before)
        for name in ("b_sales", "b_places", "c_sales", "c_places"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_number_of_buckets():
    assert [buckets.buckets_for(n) for n in (0, 1 << 30, 3 << 30, 10 << 40)] == [8, 8, 16, 65536]
