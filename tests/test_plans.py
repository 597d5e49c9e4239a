"""Physical plans: what must not, and what must, be in them."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import golden
from terrier import registry
from terrier.operators.bloom import having_keys
from terrier.plans import consumer, fact, geocode, kpi, reports
from terrier.plans.warehouse import Star
from terrier.registry.core import context

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("key", registry.QUERIES)
def test_no_pair_joins_and_no_python(spark, key):
    text = plan(registry.QUERIES[key](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "PythonUDF"):
        assert operator not in text, operator


def test_filters_reach_the_scan(spark):
    ctx = context(spark, FOLDER)
    staged = plan(ctx.lazy.stg_dvf_transactions)
    assert "EqualTo(NATURE_MUTATION,Vente)" in staged
    sold = plan(kpi.eligible(ctx.gold.fct_mutation).select("PRIX_M2"))
    assert "GreaterThan(SURFACE_REELLE_BATI,0.00)" in sold
    assert "ReadSchema: struct<DATE_MUTATION" not in sold and "ADDRESS_ID" not in sold
    year = plan(
        consumer.precisely_located(
            ctx.gold.fct_mutation, ctx.gold.dim_address_enriched, consumer.dt.date(1999, 1, 1)
        )
    )
    assert "GreaterThanOrEqual(DATE_MUTATION,1999-01-01)" in year and "TakeOrderedAndProject" in year


def test_sample_is_cut_before_the_shuffle(spark):
    text = plan(reports.sample_by_level(context(spark, FOLDER).gold.dim_address_enriched))
    assert text.count("WindowGroupLimit") >= 2


def test_register_winners_are_cut_before_the_shuffle(spark):
    """One row per key and map task: a hot key cannot fill a task."""
    register = context(spark, FOLDER).lazy.stg_ban_addresses_normalized
    text = plan(geocode.exact_winners(register)).split("\n\n")[0]
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_fact_needs_one_join(spark):
    ctx = context(spark, FOLDER)
    text = plan(fact.fct_mutation(ctx.lazy.stg_dvf_transactions, ctx.gold.dim_address_enriched))
    tree = text.split("\n\n")[0]
    assert tree.count("Join") == 1


def test_hot_address_is_split_at_run_time(spark):
    """A third of the sales at one address: the merge join splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = [golden.at(str(i), "RUE", "VICTOR HUGO", "75001", "PARIS", "75") for i in range(3000)]
        some = golden.sales(spark, rows)
        copies = golden.sales(spark, [golden.sale()]).withColumn(
            "i", F.explode(F.sequence(F.lit(1), F.lit(30000)))
        )
        price = (F.lit(20001) + F.abs(F.hash("i")) % 1000000).cast("string")
        hot = copies.withColumns({"NO_PLAN": F.md5(F.col("i").cast("string")), "VALEUR_FONCIERE": price}).drop("i")
        star = Star(some.union(hot).repartition(16), golden.register(spark))
        result = star.fct_mutation
        assert len(result.collect()) == 33000
        assert "SortMergeJoin(skew=true)" in plan(result)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_results_are_ordered(spark):
    ctx = context(spark, FOLDER)
    scores = [r.MATCH_SCORE for r in reports.match_level_distribution(ctx.gold.dim_address_enriched).collect()]
    assert scores == sorted(scores, reverse=True)
    order = ["EXACT", "SANS_TYPE", "VOIE_SEULE", "CODE_POSTAL", "COMMUNE", "NO_MATCH"]
    levels = [r[0] for r in consumer.geocoding_quality(ctx.gold.fct_mutation).collect()]
    assert levels == [x for x in order if x in levels]
    prices = [r.VALEUR_FONCIERE for r in consumer.precisely_located(
        ctx.gold.fct_mutation, ctx.gold.dim_address_enriched, consumer.dt.date(1995, 1, 1)).collect()]
    assert len(prices) > 1 and prices == sorted(prices, reverse=True)


def test_periods_prune_the_stored_fact(spark):
    """The fact is split by year: a period names the folders to read."""
    ctx = context(spark, FOLDER)
    for key in ("d_1_filters", "qry_1_median_by_commune", "qry_3_monthly_trend", "qry_5_precisely_located",
                "chk_5_conditional_relationship"):
        text = plan(registry.QUERIES[key](spark, FOLDER))
        fact_scans = [x for x in text.split("\n\n") if "PartitionFilters" in x]
        if not fact_scans:  # medians have read the fact already, for their histogram
            sold = fact.sold_in(ctx.gold.fct_mutation, 1998)
            fact_scans = [x for x in plan(sold).split("\n\n") if "PartitionFilters" in x]
        assert any("ANNEE#" in x.split("PartitionFilters")[1].split("\n")[0] for x in fact_scans), key


def test_a_stored_star_parses_raw_sales_once(spark):
    """Six tables are built from the written staged sales, none from the raw text."""
    star = context(spark, FOLDER).gold
    raw = {f.split("/")[-2] for f in star.bronze_dvf.inputFiles()}
    for df in (star.sales, star.table("dim_parcelle")):
        assert raw.isdisjoint(f.split("/")[-2] for f in df.inputFiles())
    tree = plan(fact.fct_mutation(star.sales, star.dim_address_enriched))
    assert "NATURE_MUTATION" in tree and "regexp" not in tree.split("\n\n")[0]


def test_the_register_is_cut_in_its_scan_and_reduced_before_shuffles(spark):
    """A broadcast filter drops unasked rows; what is shuffled after the register's rows is reduced before.

    Exact levels: one exchange serves choice and join. Streets and postcodes merge points first, by keys that
    split a hot street, and move one row a key and task for the choice.
    """
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        ctx = context(spark, FOLDER)
        register = ctx.lazy.stg_ban_addresses_normalized
        for level, key in geocode.LEVEL_KEYS.items():
            keyed = ctx.gold.dim_address.withColumn("key", geocode.sale_match_keys()[level])
            asked = having_keys(register, key, keyed, "key", 1000)
            tree = plan(geocode.lookup_left(keyed, geocode.LEVEL_SIDES[level](asked), "key")).split("\n\n")[0]
            assert tree.count("BroadcastExchange") == 1
            # By shuffle: the addresses for the filter, the addresses, the register, its merged points.
            merged = level in ("VOIE_SEULE", "CODE_POSTAL")
            assert tree.count("Exchange") - tree.count("BroadcastExchange") == 3 + merged, level
            if level == "VOIE_SEULE":
                assert tree.count("WindowGroupLimit") == 2
    finally:
        spark.conf.set(threshold, before)
