"""Mixing sources to target weights over a tree of levels, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.shared import written

EPOCH = "__mix_epoch"
_TOKENS, _KEY, _CHUNK = "__mix_tokens", "__mix_key", "__mix_chunk"
_CHUNK_DIGITS = 3  # an epoch's order is numbered over 16**3 chunks of each leaf


@dataclass(frozen=True)
class Level:
    """One level of the tree: the name of its node for a row, and the node's weight among its
    siblings, an integer that may depend on the levels above by their names. Null names count
    as the empty string."""

    name: str
    value: Column
    weight: Column


def about_tokens(text: Column) -> Column:
    """A document's length in tokens without a tokenizer: a quarter of its UTF-8 bytes, and its end."""
    return (F.floor(F.octet_length(F.coalesce(text, F.lit(""))) / 4) + 1).cast("long")


def _share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Deals each parent's ``budget`` to its nodes by ``weight``, at most ``cap`` each.

    What a node cannot take goes to its siblings by their weights. Nodes come in the
    order in which they fill up; the water level is the highest that any node, being
    the first not to fill up, would give.
    """
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    filling = siblings.orderBy(F.col("cap") / F.col("weight"), name)
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    rest = F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    return (
        nodes.filter("weight > 0")
        .withColumn("level", left.cast("double") / rest.cast("double"))
        .withColumn("level", F.max("level").over(siblings))
        .withColumn("budget", F.least("cap", F.floor(F.col("weight") * F.col("level"))))
        .drop("level")
    )


def leaf_budgets(leaves: DataFrame, levels: Sequence[Level], total: int, max_epochs: int) -> DataFrame:
    """Budget of every leaf, from leaf rows with the levels' names and ``supply`` tokens.

    Weights are propagated from the root. A node's capacity is that of the leaves
    below it, so a shortage is made up among the siblings first; only what all of
    them together lack falls to the siblings of their parent.
    """
    names = [f"__mix_{v.name}" for v in levels]
    leaves = leaves.withColumn("cap", F.col("supply") * max_epochs)
    above = None
    for depth, level in enumerate(levels):
        path, parent = names[: depth + 1], names[:depth]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
        nodes = nodes.select("*", *(F.col(n).alias(v.name) for n, v in zip(path, levels)))
        nodes = nodes.withColumn("weight", level.weight.cast("long")).drop(*(v.name for v in levels[: depth + 1]))
        nodes = nodes.withColumn("budget", F.lit(total).cast("long")) if above is None else nodes.join(above, parent)
        dealt = _share_out(nodes, parent, names[depth])
        above = dealt.select(*path, "budget")
    return dealt.select(*names, "supply", "budget")


def _settle(leaves: DataFrame, names: list[str]) -> DataFrame:
    """Which leaves give one document more, as a column ``more``.

    Whole documents rarely end where a budget does. What leaves lack (``shortage``) is pooled among siblings, and of these the ones whose
    next document (``extra`` tokens, null without one) is shortest take it, as long as the pool pays for it. What is left
    falls to the level above, whose nodes each offer their shortest next document, and so on up to the root.
    """
    leaves = leaves.withColumn("more", F.lit(False))
    siblings = Window.partitionBy(*names[:-1]) if names[:-1] else Window.partitionBy(F.lit(0))
    paid = F.sum("extra").over(siblings.orderBy("extra", names[-1])) <= F.sum("shortage").over(siblings)
    leaves = leaves.withColumn("more", F.coalesce(F.col("extra").isNotNull() & paid, F.lit(False)))
    for depth in range(len(names) - 2, -1, -1):
        path, parent = names[: depth + 1], names[:depth]
        offer = F.when(~F.col("more") & F.col("extra").isNotNull(), F.struct("extra", *names[depth + 1 :]))
        nodes = leaves.groupBy(*path).agg(
            F.sum(F.col("shortage") - F.when(F.col("more"), F.col("extra")).otherwise(0)).alias("pool"), F.min(offer).alias("offer")
        )
        over = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))  # one row for each child of a node
        paid = F.sum("offer.extra").over(over.orderBy("offer.extra", *path[-1:])) <= F.sum("pool").over(over)
        won = nodes.withColumn("paid", paid).filter("offer IS NOT NULL AND paid")
        won = won.select(*path, *(F.col(f"offer.{n}").alias(n) for n in names[depth + 1 :]), F.lit(True).alias("won"))
        leaves = leaves.join(won, names, "left").withColumn("more", F.col("more") | F.coalesce("won", F.lit(False))).drop("won")
    return leaves


def mix_documents(
    docs: DataFrame,
    levels: Sequence[Level],
    *,
    id_col: str = "doc_id",
    tokens: Column | None = None,
    text_col: str = "text",
    share: float = 1.0,
    max_epochs: int = 1,
    seed: int = 17,
) -> DataFrame:
    """The rows that the mixture takes, once for each epoch, with all columns and ``EPOCH`` (from 0).

    The total budget is ``share`` of all tokens. A leaf whose budget is ``e`` times
    its supply and more gives ``e`` whole epochs, and of the next one the longest
    prefix of whole documents within the rest; what these lack of the rest pays for the next document of
    a sibling, then of the level above (see ``_settle``), and no leaf goes beyond ``max_epochs``. An epoch's order is that of a digest
    of seed, epoch and id, so rows that repeat an id come together. Null names are
    the empty string, null ids share one place, a null text has one token (its end),
    a node of weight 0 gives nothing, an empty table gives no rows.

    Documents never meet in one task by leaf: token sums of fixed chunks of the order
    find the chunk in which the budget ends, and only that chunk's rows are ordered.
    """
    names = [f"__mix_{v.name}" for v in levels]
    leaf = [F.coalesce(v.value.cast("string"), F.lit("")).alias(n) for n, v in zip(names, levels)]
    count = about_tokens(F.col(text_col)) if tokens is None else tokens.cast("long")
    key_of = lambda epoch: F.md5(F.concat_ws(":", F.lit(seed), epoch, F.col(id_col)).cast("binary"))
    rows = docs.select(F.col(id_col), count.alias(_TOKENS), *leaf)
    leaves = written(rows.groupBy(*names).agg(F.sum(_TOKENS).alias("supply")), "leaves")
    supply = leaves.agg(F.sum("supply")).first()[0] or 0
    plan = leaf_budgets(leaves, levels, int(supply * share), max_epochs)
    plan = plan.select(*names, F.floor(F.col("budget") / F.col("supply")).alias("whole"), (F.col("budget") % F.col("supply")).alias("rest"))
    plan = written(plan, "budgets")

    keyed = rows.join(plan, names).withColumn(_KEY, key_of(F.col("whole"))).withColumn(_CHUNK, F.substring(_KEY, 1, _CHUNK_DIGITS))
    along = Window.partitionBy(*names).orderBy(_CHUNK)
    last = (
        keyed.groupBy(*names, "rest", _CHUNK)
        .agg(F.sum(_TOKENS).alias("n"))
        .withColumn("through", F.sum("n").over(along))
        .filter(F.col("through") > F.col("rest"))
        .groupBy(*names, "rest")
        .agg(F.min(F.struct(_CHUNK, (F.col("through") - F.col("n")).alias("before"))).alias("last"))
        .select(*names, F.col(f"last.{_CHUNK}").alias(_CHUNK), F.col("last.before").alias("before"))
    )
    inside = Window.partitionBy(*names, _CHUNK).orderBy(_KEY)  # equal keys count together
    fits = F.col("through") <= F.col("rest")
    ends = (
        keyed.join(last, [*names, _CHUNK])
        .withColumn("through", F.col("before") + F.sum(_TOKENS).over(inside))
        .groupBy(*names, _CHUNK)
        .agg(
            F.max(F.when(fits, F.col(_KEY))).alias("cut"),
            F.coalesce(F.max(F.when(fits, F.col("through"))), F.first("before")).alias("given"),
            F.min(F.when(~fits, F.struct("through", _KEY))).alias("next"),
        )
        .select(*names, F.coalesce("cut", _CHUNK).alias("cut"), "given", "next")
    )
    plan = plan.join(ends, names, "left").withColumn("shortage", F.coalesce(F.col("rest") - F.col("given"), F.lit(0)))
    plan = plan.withColumn("extra", F.when(F.col("whole") < max_epochs, F.col("next.through") - F.col("given")))
    plan = _settle(written(plan, "ends"), names)
    cut = F.when(F.col("more"), F.col(f"next.{_KEY}")).otherwise(F.coalesce("cut", F.lit("")))
    plan = written(plan.select(*names, "whole", cut.alias("cut")), "cuts")

    taken = docs.select("*", *leaf).join(plan, names)
    copies = F.col("whole") + (key_of(F.col("whole")) <= F.col("cut")).cast("int")
    taken = taken.withColumn(EPOCH, copies).filter(F.col(EPOCH) > 0)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col(EPOCH) - 1)).alias(EPOCH))
