"""Mixing sources to target weights. DataFrame operations only.

Targets come from capped water-filling: with level ``t`` a source of weight
``w`` and size ``s`` gets ``min(w * t, epochs * s)``. The level starts at
(all sizes) / (all weights); sources above their cap are clamped, and the level
is raised over the rest until none is above. Each step is one aggregate over
the table of sources that returns two sums.

A source's documents are all taken as often as whole repetitions fit, and some
of them once more: those first in a seeded hash order that fit into what is
left, then (``fills`` times) those that fit of the rest. The place in hash
order where a source is cut is found by digits of the hash, with at most 4096
sums per source and step, so no source is ever sorted or windowed as a whole,
and a document's fate depends on its own row and its source's cuts only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import join_small, word_count
from tidemark.session import cut_lineage

DIGITS = 3  # hexadecimal digits of the hash that one step looks at
STEPS = 2
END = "~"  # after every hash


def hash_order(doc_id: Column, seed: int) -> Column:
    """Seeded place of a document: the first 16 hexadecimal digits of an MD5."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 16)


def ranked(df: DataFrame, order: Column, name: str) -> DataFrame:
    """Number the rows from 0 in ``order``, without bringing them into one task."""
    parts = cut_lineage(
        df.repartitionByRange(order).withColumn("__part", F.spark_partition_id())
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # a row per partition
    starts = starts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    return (
        parts.withColumn("__place", place).join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + F.col("__place")).drop("__part", "__place", "__start")
    )


def targets(sources: DataFrame, epochs: int) -> DataFrame:
    """Add ``target`` to rows of (source, source_size, weight)."""
    sources = cut_lineage(sources)
    cap = F.col("source_size") * epochs
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = total / weights if total else 0.0
    while True:
        above = F.col("weight") * F.lit(level) > cap
        capped, open_weights = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        raised = (total - capped) / open_weights if total and open_weights else level
        if raised <= level:
            break
        level = raised
    above = F.col("weight") * F.lit(level) > cap
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(F.col("weight") * F.lit(level)))


def _taken(size: str, at: Column, fills: int) -> Column:
    """In one of the fills so far: small enough for it, and not after its cut."""
    found = F.lit(False)
    for i in range(fills):
        found = found | ((F.col(size) <= F.col("__fits")[i]) & (at <= F.col("__cuts")[i]))
    return found


@dataclass(frozen=True)
class Mix:
    """``sources``: a row per source with target, whole repetitions and cuts."""

    sources: DataFrame
    count: int
    fills: int
    seed: int

    def repetitions(self, docs: DataFrame, size: str, doc_id: str, source: str) -> DataFrame:
        """Add source_size, target and ``repetitions`` to rows that have their size."""
        cuts = self.sources.withColumnRenamed("source", source)
        joined = join_small(docs, cuts, [source], self.count)
        at = F.struct(hash_order(F.col(doc_id), self.seed).alias("u"), F.col(doc_id).alias("id"))
        more = (F.col(size) > 0) & _taken(size, at, self.fills)
        return joined.withColumn("repetitions", F.col("whole") + more.cast("bigint")).drop(
            "whole", "__cuts", "__fits"
        )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, fills: int = 4, seed: int = 7,
) -> Mix:
    """Plan the mix: sources in code point order (null last) take ``weights`` in turn.

    Null texts have size 0; a source of size 0 has target 0. Rows that repeat a
    doc_id are taken alike. An empty table gives an empty plan. Other columns
    take no part.
    """
    sized = cut_lineage(
        docs.select(
            F.col(doc_id).alias("id"), F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            hash_order(F.col(doc_id), seed).alias("u"),
        )
    )
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = ranked(sums, F.asc_nulls_last("source"), "__rank")
    turn = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod("__rank", F.lit(len(weights))).cast("int"))
    planned = targets(numbered.select("source", "source_size", turn.alias("weight")), epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio)
    place = docs.select(F.struct(F.lit("").alias("u"), F.col(doc_id).alias("id"))).schema[0].dataType.simpleString()
    state = cut_lineage(
        planned.select(
            "source", "source_size", "target", whole.alias("whole"),
            (F.col("target") - whole * F.col("source_size")).alias("left"),
            F.expr("cast(array() as array<double>)").alias("__fits"),
            F.expr(f"cast(array() as array<{place}>)").alias("__cuts"),
        )
    )
    count = state.count()
    for fill in range(fills):
        state = _fill(sized.filter("size > 0"), state, count, fill, place)
    return Mix(state.drop("left"), count, fills, seed)


def _fill(places: DataFrame, state: DataFrame, count: int, fill: int, place: str) -> DataFrame:
    """Find each source's cut: the last place up to which what fits is taken."""
    state = state.withColumns({"__fits": F.concat("__fits", F.array("left")), "prefix": F.lit("")})
    at = F.struct("u", "id")
    for step in range(STEPS + 1):
        last = step == STEPS
        key = at if last else F.struct(
            F.substring("u", 1, DIGITS * (step + 1)).alias("u"), F.lit(None).cast(places.schema["id"].dataType).alias("id")
        )
        narrow = state.select("source", "prefix", "__fits", "__cuts")
        here = join_small(places, narrow, ["source"], count).filter(
            F.startswith("u", "prefix") & (F.col("size") <= F.col("__fits")[fill]) & ~_taken("size", at, fill)
        )
        sums = here.groupBy("source", key.cast(place).alias("key")).agg(F.sum("size").cast("double").alias("n"))
        # A row of its own keeps sources that have nothing here.
        sums = sums.unionByName(state.select("source", F.lit(None).cast(place).alias("key"), F.lit(0.0).alias("n")))
        lists = sums.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("key", "n"))).alias("__sums"))
        found = join_small(lists, state, ["source"], count).withColumn("__at", _crossing(place))
        if last:
            end = F.when(F.col("prefix") == END, F.struct(F.lit(END).alias("u"), F.lit(None).alias("id")).cast(place))
            first = F.struct(F.col("prefix").alias("u"), F.lit(None).alias("id")).cast(place)
            cut = F.coalesce(end, F.col("__at.key"), first)
            found = found.withColumns(
                {"left": F.col("left") - F.col("__at.sum"), "__cuts": F.concat("__cuts", F.array(cut))}
            ).drop("prefix")
        else:
            found = found.withColumns(
                {"left": F.col("left") - F.col("__at.sum"), "prefix": F.coalesce("__at.over.u", F.lit(END))}
            )
        state = cut_lineage(found.drop("__sums", "__at"))
    return state


def _crossing(place: str) -> Column:
    """Fold sorted sums: what fits into ``left``, its last key, and the key that goes beyond."""
    start = F.expr(f"cast(struct(0D, null, null) as struct<sum:double,key:{place},over:{place}>)")

    def add(acc: Column, x: Column) -> Column:
        total = acc["sum"] + x["n"]
        fits = acc["over"].isNull() & (total <= F.col("left"))
        key = F.when(fits, F.coalesce(x["key"], acc["key"])).otherwise(acc["key"])
        over = F.when(acc["over"].isNull() & ~fits, x["key"]).otherwise(acc["over"])
        return F.struct(F.when(fits, total).otherwise(acc["sum"]).alias("sum"), key.alias("key"), over.alias("over"))

    return F.aggregate("__sums", start, add)
