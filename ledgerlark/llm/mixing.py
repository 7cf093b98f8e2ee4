"""Documents chosen so that the sources of a corpus meet target weights, by hierarchical budgeting.

Budgets go down a tree of domains, languages and sources. A node splits its budget among its children by weight; a child
that cannot use its share is filled up, and what it leaves is split among its siblings by weight again. Only what a
whole family cannot use is left to the family's own siblings: a child's capacity is all that its subtree can give. Each
leaf then takes a prefix of its documents in an order drawn by seed and epoch, and starts a new epoch when one is used
up. Everything is DataFrame and SQL functions; nothing but the tree's nodes is ever gathered.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import lowered
from ledgerlark.operators.lineage import materialise

DOMAINS = 4  # domains that sources are dealt to where a table names none
SLICES = 4096  # of the order of a leaf and epoch that are summed before the place of the cut is known


@dataclass(frozen=True)
class Mix:
    """levels: columns from the root to the leaves. weights: for a level, the integer weight of a value among its
    siblings (1 where none is named). per_mille: the budget in thousandths of all tokens. epochs: how often a leaf may be
    read."""

    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    per_mille: int = 700
    epochs: int = 1
    seed: int = 17


#: Weights of the registered query and of the pipeline's stage.
PRODUCTION = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 2}}
NONE = "\\N"  # stands for a null value of a level


def tokens_of(text: str) -> Column:
    """Number of words of a text; a null or empty text has none."""
    words = F.split(lowered(F.col(text)), "[\\x20\\t-\\r]+")
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


def _text_of(column: str) -> Column:
    """A value as text, NONE for null; a text that looks like NONE gets one more backslash, so that none equals it."""
    value = F.col(column).cast("string")
    return F.coalesce(F.when(value.rlike(r"^\\+N$"), F.concat(F.lit("\\"), value)).otherwise(value), F.lit(NONE))


def _free(name: str, taken: list[str]) -> str:
    """A column name that a table does not have yet."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def domain_of(source: str) -> Column:
    """A domain for tables without one: the source's first md5 digit, modulo DOMAINS."""
    digit = F.conv(F.substring(F.md5(F.coalesce(F.col(source).cast("string"), F.lit(NONE))), 1, 1), 16, 10).cast("int")
    return F.concat(F.lit("d"), (digit % DOMAINS).cast("string"))


def _order(seed: int, epoch: Column, doc: Column) -> Column:
    """Place of a document in an epoch's order: the md5 of seed, epoch and document, as text."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), doc))


def _weight(level: str, mix: Mix) -> Column:
    named = mix.weights.get(level, {})
    if not named:
        return F.lit(1)
    table = F.create_map(*[x for k, v in named.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(table, F.col(level)), F.lit(1))


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(levels, capacity, budget) of every leaf from (levels, tokens): whole tokens, rounded down at every level.

    At each level siblings are ordered by capacity per weight. If the first k are filled up, the rest share what is left
    by weight; k is the least for which nobody of the rest gets more than its capacity.
    """
    levels, wide = list(mix.levels), lambda x: x.cast("decimal(28,0)")  # products of 64-bit numbers may be larger than these
    nodes = leaves.withColumn("capacity", F.col("tokens") * mix.epochs)
    total = leaves.agg((F.sum("tokens").cast("decimal(38,0)") * F.lit(mix.per_mille)).alias("t")).select(F.expr("t div 1000")).scalar()
    placed = nodes.withColumn("parent_budget", total)
    for depth, level in enumerate(levels):
        path, above = levels[: depth + 1], levels[:depth]
        child = placed.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.max("parent_budget").alias("given"))
        child = child.withColumn("weight", _weight(level, mix).cast("long"))
        order = [F.col("capacity") / F.col("weight"), F.col(level)]
        earlier = Window.partitionBy(*above).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        family = Window.partitionBy(*above)
        child = (
            child.withColumn("used", F.coalesce(F.sum("capacity").over(earlier), F.lit(0)))
            .withColumn("gone", F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
            .withColumn("left", F.sum("weight").over(family) - F.col("gone"))
            .withColumn("fits", wide(F.col("given") - F.col("used")) * F.col("weight") <= wide(F.col("capacity")) * F.col("left"))
            .withColumn("unit", F.when(F.col("fits"), F.struct("gone", "used", "left")))
            .withColumn("unit", F.min("unit").over(family))
        )
        child = child.withColumn("due", (F.col("given") - F.col("unit.used")).cast("decimal(38,0)") * F.col("weight"))
        share = F.expr("due div unit.left")
        granted = F.when(F.col("unit").isNull(), F.col("capacity")).otherwise(F.least("capacity", share))
        child = child.select(*path, granted.alias("granted"))
        placed = placed.drop("parent_budget").join(child.withColumnRenamed("granted", "parent_budget"), path)
    return placed.withColumnRenamed("parent_budget", "budget")


def mixture(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The chosen rows of `docs`, all columns, with `mix_epoch` and `mix_tokens` (an action).

    A row comes once for each epoch that takes it. Columns of `docs` keep their names and values; where it has a
    `mix_epoch` or `mix_tokens` of its own, the new column's name gets underscores behind it. The prefix of a leaf's last epoch ends before the first document
    that would exceed the budget. Null level values are a value of their own; null and empty texts have no tokens and
    stay with their leaf's order; rows of equal id and text are taken together or not at all. An empty table gives an
    empty result.
    """
    levels, key = list(mix.levels), ["mix_leaf"]
    epoch_name, tokens_name = _free("mix_epoch", docs.columns), _free("mix_tokens", docs.columns)
    values = [_text_of(c).alias(c) for c in levels]
    leaf = F.concat(*[x for c in levels for x in (F.length(_text_of(c)).cast("string"), F.lit(":"), _text_of(c))])
    doc = F.concat_ws("-", _text_of(doc_id), F.md5(F.coalesce(text, F.lit(""))))
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row"), leaf.alias("mix_leaf"), doc.alias("mix_doc"), tokens_of(text).alias("mix_tokens")
    )
    light = docs.select(leaf.alias("mix_leaf"), doc.alias("mix_doc"), tokens_of(text).alias("mix_tokens"), F.struct(*values).alias("mix_levels"))
    light = materialise(light.select("mix_leaf", "mix_doc", "mix_tokens", "mix_levels.*"), "mix-rows")
    leaves = light.groupBy(*key, *levels).agg(F.sum("mix_tokens").alias("tokens"))
    plan = materialise(budgets(leaves, mix).select("mix_leaf", "tokens", "budget"), "mix-budgets")

    # An epoch that the budget covers is taken whole; the prefix of the next one is found slice by slice.
    epochs = F.explode(F.sequence(F.lit(1), F.lit(mix.epochs)))
    open_ = plan.withColumn("epoch", epochs).withColumn("rest", F.col("budget") - (F.col("epoch") - 1) * F.col("tokens"))
    open_ = open_.where("rest > 0 or (epoch = 1 and rest = tokens)")
    partial = open_.where("rest < tokens").select("mix_leaf", "epoch", "rest")
    placed = light.join(partial, "mix_leaf").withColumn("place", _order(mix.seed, F.col("epoch"), F.col("mix_doc")))
    placed = placed.withColumn("slice", F.conv(F.substring("place", 1, 3), 16, 10).cast("int") % SLICES)
    ties = placed.groupBy("mix_leaf", "epoch", "rest", "slice", "place").agg(F.sum("mix_tokens").alias("n"))
    ties = materialise(ties, "mix-places")
    slices = ties.groupBy("mix_leaf", "epoch", "rest", "slice").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy("mix_leaf", "epoch").orderBy("slice")
    slices = slices.withColumn("upto", F.sum("n").over(up_to)).withColumn("before", F.col("upto") - F.col("n"))
    border = slices.where("before <= rest and upto > rest").groupBy("mix_leaf", "epoch", "rest").agg(F.min(F.struct("slice", "before")).alias("at"))
    inside = ties.join(border.select("mix_leaf", "epoch", F.col("at.slice").alias("slice"), F.col("at.before").alias("before")), ["mix_leaf", "epoch", "slice"])
    within = Window.partitionBy("mix_leaf", "epoch", "slice").orderBy("place")
    over = inside.where(F.col("before") < F.col("rest") + 1).withColumn("upto", F.col("before") + F.sum("n").over(within))
    cut = over.where("upto > rest").groupBy("mix_leaf", "epoch").agg(F.min("place").alias("cut"))
    takes = open_.select("mix_leaf", "epoch", (F.col("rest") >= F.col("tokens")).alias("whole")).join(cut, ["mix_leaf", "epoch"], "left")
    takes = materialise(takes.groupBy("mix_leaf").agg(F.collect_list(F.struct("epoch", "whole", "cut")).alias("mix_takes")), "mix-takes")

    place = lambda t: _order(mix.seed, t["epoch"], F.col("mix_doc"))
    taken = F.filter("mix_takes", lambda t: t["whole"] | t["cut"].isNull() | (place(t) < t["cut"]))
    chosen = own.join(takes, "mix_leaf").withColumn("mix_epoch", F.explode(F.transform(taken, lambda t: t["epoch"])))
    return chosen.select("mix_row.*", F.col("mix_epoch").alias(epoch_name), F.col("mix_tokens").alias(tokens_name))
