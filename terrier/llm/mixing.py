"""Mixing sources to target weights by hierarchical budgeting.

A tree of groups (by default domain, language, source) carries target weights. The token budget
goes down the tree: siblings share their parent's budget in proportion to their weights; a group
whose whole subtree cannot fill its share, every document used ``max_epochs`` times, takes what it
can, and its siblings share the shortage by weight. So a shortage reaches the siblings of an
ancestor only if all siblings together fall short. Shares of one family are found at once: sorted by
capacity / weight, the groups that fill up are a prefix, which a running sum finds.

Each leaf then reads its documents epoch by epoch. Complete epochs take every document; of the last
one, ordered by the MD5 of seed, epoch and document, the shortest prefix that fills the budget is taken:
the document that reaches it is in, so a leaf exceeds its budget by less than one document.
Running totals over a leaf that holds most rows never meet in one task: documents are dealt into
``SLICES`` equal ranges of that MD5, and a document's total is that of the ranges before it and of
its own range.

Nulls: a null path column is a group of its own, named ``(none)``; a null text has no tokens; a null
document id is ordered as an empty one. Repeated rows count and are taken one by one, ties of MD5 and
id in any order. Documents without tokens cost nothing and go with the prefix around them. An empty
table gives an empty result. Columns of the input other than those named are not touched and may
have any name that does not start with ``mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.session import written

SLICES = 4096  # ranges of three hexadecimal digits


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, float]) -> Column:
    weight = F.lit(1.0)
    for name, value in weights.items():
        weight = F.when(F.col(level) == name, F.lit(float(value))).otherwise(weight)
    return weight


def _shared(groups: DataFrame, parent: list[str], weight: Column) -> DataFrame:
    """Adds ``mix_budget`` to siblings that have ``mix_capacity`` and their parent's ``mix_given``."""
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = family.orderBy("mix_ratio", *[c for c in groups.columns if c.startswith("mix_level")])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = family.orderBy(F.desc("mix_ratio"),
                          *[F.desc(c) for c in groups.columns if c.startswith("mix_level")])
    sized = groups.withColumn("mix_weight", weight).withColumn(
        "mix_ratio", F.when(F.col("mix_weight") > 0, F.col("mix_capacity") / F.col("mix_weight"))
        .otherwise(F.lit(float("inf"))))
    # Level that this group and all with a larger ratio reach if all smaller ones are full.
    level = (F.col("mix_given") - F.coalesce(F.sum("mix_capacity").over(before), F.lit(0))) / F.sum(
        "mix_weight").over(rest.rowsBetween(Window.unboundedPreceding, 0))
    leveled = sized.withColumn(
        "mix_level_at", F.when(F.col("mix_weight") > 0, level)
    ).withColumn("mix_full", F.col("mix_ratio") <= F.col("mix_level_at"))
    # Beyond the first group that does not fill up, the level only falls: the largest is the right one.
    water = F.max(F.when(~F.col("mix_full"), F.col("mix_level_at"))).over(family)
    share = F.when(F.col("mix_weight") <= 0, F.lit(0)).when(
        F.col("mix_full"), F.col("mix_capacity")
    ).otherwise(F.floor(F.least(water * F.col("mix_weight"), F.col("mix_capacity"))))
    return leveled.withColumn("mix_budget", share.cast("long")).drop(
        "mix_weight", "mix_ratio", "mix_level_at", "mix_full", "mix_given")


def budgets(leaves: DataFrame, depth: int, weights: list[dict[str, float]], total: int,
            max_epochs: int) -> DataFrame:
    """Token budget of every leaf: columns ``mix_level0``.., ``mix_tokens``, ``mix_budget``."""
    path = [f"mix_level{i}" for i in range(depth)]
    wanted = F.lit(True)
    for level, own in zip(path, weights):
        wanted &= _weight(level, own) > 0
    # What is not wanted has no capacity, at any level: its tokens cannot fill the share of a group above.
    capped = leaves.withColumn(
        "mix_capacity", F.when(wanted, F.col("mix_tokens") * max_epochs).otherwise(F.lit(0)).cast("long"))
    given = None
    for i in range(depth):
        level = path[: i + 1]
        groups = capped.groupBy(*level).agg(F.sum("mix_capacity").alias("mix_capacity"))
        if given is None:
            groups = groups.withColumn("mix_given", F.lit(total).cast("long"))
        else:
            groups = groups.join(
                given.select(*path[:i], F.col("mix_budget").alias("mix_given")), path[:i])
        given = _shared(groups, path[:i], _weight(path[i], weights[i]))
    return leaves.join(given.select(*path, "mix_budget"), path)


def mixed_documents(docs: DataFrame, path: list[Column], weights: list[dict[str, float]], *,
                    tokens: Column | None = None, share: float = 0.8, max_epochs: int = 2,
                    seed: str = "mix", id_column: str = "doc_id") -> DataFrame:
    """The input's rows that are taken, plus ``mix_level0``.., ``mix_tokens`` and ``mix_copies``.

    ``path`` names the groups from the root down, ``weights`` has for each level the weights of its
    names (1 for names not listed, 0 for none of it). The budget is ``share`` of all tokens, which
    ``tokens`` counts (the words of column ``text`` if not given).
    """
    depth = len(path)
    names = [f"mix_level{i}" for i in range(depth)]
    marked = docs.withColumns(
        {n: F.coalesce(c.cast("string"), F.lit("(none)")) for n, c in zip(names, path)}
        | {"mix_tokens": word_count(F.col("text")) if tokens is None else tokens})
    leaves = marked.groupBy(*names).agg(F.sum("mix_tokens").alias("mix_tokens"))
    total = leaves.agg(F.sum("mix_tokens")).first()[0] or 0
    plan = budgets(leaves, depth, weights, int(total * share), max_epochs)
    # Written: with its size known, the plan of some leaves is sent to the documents, which would
    # otherwise be shuffled by leaf, a hot one into one task.
    plan = written(plan.select(
        *names,
        F.when(F.col("mix_tokens") > 0, F.expr("mix_budget div mix_tokens")).otherwise(0)
        .cast("long").alias("mix_epochs"),
        F.when(F.col("mix_tokens") > 0, F.expr("mix_budget % mix_tokens")).otherwise(0)
        .cast("long").alias("mix_rest")), "mix-plan")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("mix_epochs").cast("string"),
                            F.coalesce(F.col(id_column).cast("string"), F.lit(""))))
    keyed = marked.join(plan, names).withColumn("mix_key", key).withColumn(
        "mix_slice", F.substring("mix_key", 1, 3))
    # Written, so that the sums of a leaf's slices are complete before they meet in one task: as one
    # plan, every map task's part of them would go there.
    slices = written(keyed.groupBy(*names, "mix_slice").agg(
        F.sum("mix_tokens").alias("mix_in_slice")), "mix-slices")
    running = Window.partitionBy(*names).orderBy("mix_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    slices = slices.select(*names, "mix_slice", F.coalesce(
        F.sum("mix_in_slice").over(running), F.lit(0)).alias("mix_before"))
    within = Window.partitionBy(*names, "mix_slice").orderBy("mix_key", id_column).rowsBetween(
        Window.unboundedPreceding, 0)
    earlier = F.col("mix_before") + F.sum("mix_tokens").over(within) - F.col("mix_tokens")
    taken = earlier < F.col("mix_rest")
    return (
        keyed.join(slices, [*names, "mix_slice"])
        .withColumn("mix_copies", F.col("mix_epochs") + taken.cast("long"))
        .filter("mix_copies > 0")
        .drop("mix_epochs", "mix_rest", "mix_key", "mix_slice", "mix_before")
    )
