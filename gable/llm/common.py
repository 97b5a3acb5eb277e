"""Helpers of the training-data operators: input shapes, sized joins, components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gable.runtime import row_count, stage

#: A staged side of at most so many narrow rows (ids and a few numbers, under
#: 32 bytes each, so about 16 MB) may be broadcast. Larger sides are shuffled.
BROADCAST_IDS = 500_000

#: White space of every operator here, and all but white space.
SPACE = r"[ \t\n\x0B\f\r]+"
BLANKS = " \t\n\x0b\f\r"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, whatever else the table has; a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def words(text: Column) -> Column:
    """Words of a text, an empty array where there are none."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def settled(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Adds ``columns`` (SQL text or Column) that are computed once for each row.

    A filter or projection on an expensive array expression is otherwise copied
    below it by the optimizer, even into lambdas that run for every element. An
    outer explode of one struct keeps rows as they are and is never crossed.
    """
    pieces = [(F.expr(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    once = df.select("*", F.explode_outer(F.array(F.struct(*pieces))).alias("__once"))
    return once.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"__once.{name}").alias(name) for name in columns])


def sized_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, limit: int = BROADCAST_IDS) -> DataFrame:
    """Join to a narrow side, staged and counted: broadcast up to ``limit`` rows, else a shuffle join."""
    side = stage(right, "side")
    return left.join(F.broadcast(side) if row_count(side) <= limit else side, list(on), how)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component``: the smallest node that each node of ``edges`` reaches.

    Alternates two steps until nothing changes: every node takes the smallest
    label among its neighbours, then labels jump to the label of their label.
    Each round is a few aggregates on the nodes, staged in the shared folder, so
    a lost executor costs one round at most. Rounds grow with the logarithm of
    the longest chain. Edges may repeat and point either way.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = stage(both.union(both.select("v", "u")).distinct(), "links")
    label = stage(links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("c")), "label")
    if row_count(label) == 0:
        return label.selectExpr("u AS node", "c AS component")
    while True:
        # edges between components that still differ, in terms of their labels
        here, there = label.selectExpr("u", "c AS cu"), label.selectExpr("u AS v", "c AS cv")
        left = links.join(here, "u").join(there, "v").where("cu <> cv").select("cu", "cv").distinct()
        pending = stage(left, "pending")
        if row_count(pending) == 0:
            return label.selectExpr("u AS node", "c AS component")
        hook = pending.groupBy("cu").agg(F.min("cv").alias("to")).where("to < cu")
        hook = stage(hook, "hook")
        # follow hooks to their end: each jump doubles the distance covered
        while True:
            nxt = hook.selectExpr("cu AS to", "to AS further")
            jumped = hook.join(nxt, "to", "left").selectExpr("cu", "coalesce(further, to) AS to", "further IS NOT NULL AS moved")
            jumped = stage(jumped, "jump")
            if jumped.where("moved").limit(1).count() == 0:
                break
            hook = jumped.select("cu", "to")
        label = stage(
            label.join(hook.selectExpr("cu AS c", "to"), "c", "left").selectExpr("u", "coalesce(to, c) AS c"), "label"
        )
