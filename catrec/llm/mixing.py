"""Mixing sources to target token weights by entropy balancing.

The rates w of the documents minimise the relative entropy to a uniform rate,
every word weighing alike, under one token constraint per source.  The convex
dual has one multiplier per source and w = exp(multiplier); Newton steps on it
run over the per-source sums that Spark has aggregated.  Rates are rounded into
whole copies by error diffusion inside bounded groups of a source, so a
source's words come out within a few words per group of its target.

Cases: null text counts no words; documents without words get no copy beyond
their rate's whole part; a null source is a source of its own and comes last;
rows equal in all columns are rounded apart in any order with the same sum; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import global_order, stored, widened

WORD = r"[^\x20\x09-\x0D]+"
#: Documents (expected) that one rounding group holds.
GROUP_ROWS = 1000
NEWTON_STEPS = 50
TOLERANCE = 1e-12


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, rows, source_size, target): ``share`` of all sizes dealt by weight, ``most`` times a source's size at most.

    Sources stand in code-point order, null last, and take the weights in
    turn.  What a full source leaves is dealt again by weight; the level at
    which all is dealt is found by rounds of sums over the sources.
    """
    totals = stored(sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size")))
    ordered, _, total = global_order(totals, [F.col("source").asc_nulls_last()], "source_size")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("position") % len(weights) + 1).cast("int"))
    dealt = ordered.select("source", "rows", "source_size", turn.alias("weight"),
                           (F.col("source_size") * F.lit(float(most))).alias("full"))
    budget, level = share * total, 0.0
    while True:
        above = F.col("weight") * F.lit(level) >= F.col("full")
        sums = dealt.agg(F.sum(F.when(above, F.col("full")).otherwise(0.0)).alias("held"),
                         F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not sums["open"]:
            break
        raised = (budget - sums["held"]) / sums["open"]
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    return dealt.select("source", "rows", "source_size",
                        F.least(F.col("weight") * F.lit(level), F.col("full")).alias("target"))


def balance(targets: DataFrame) -> DataFrame:
    """Adds ``rate``: exp of the multiplier that the Newton iteration on the dual reaches for each constraint.

    The dual of a source with size S and target T is S exp(m) - m T, convex in
    m; its gradient is S exp(m) - T, its curvature S exp(m).  A step is damped
    to one unit, and the iteration ends when no constraint is off by more than
    the tolerance.
    """
    state = targets.withColumn("multiplier", F.lit(0.0))
    live = (F.col("source_size") > 0) & (F.col("target") > 0)
    held = F.col("source_size") * F.exp("multiplier")
    for step in range(1, NEWTON_STEPS + 1):
        move = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("target") - held) / held))
        state = state.withColumn("multiplier", F.when(live, F.col("multiplier") + move).otherwise(F.lit(0.0)))
        if step % 8 == 0:
            state = stored(state)
            off = state.agg(F.max(F.when(live, F.abs(held - F.col("target")) / F.col("target")))).first()[0]
            if off is None or off < TOLERANCE:
                break
    else:
        raise ArithmeticError(f"the Newton iteration did not come within {TOLERANCE} of the targets in {NEWTON_STEPS} steps")
    return state.withColumn("rate", F.when(live, F.exp("multiplier")).otherwise(F.lit(0.0))).drop("multiplier")


def round_copies(rated: DataFrame, keys: list[str]) -> DataFrame:
    """Whole ``copies`` for rows with ``source``, ``group``, ``size``, ``rate``: error diffusion, large documents first.

    Each group (of bounded expected size) carries its own error, which ends
    below half of its smallest document.
    """
    names = rated.columns
    schema = widened(rated.schema, "copies int")

    def diffuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, owed = None, 0.0
        for batch in batches:
            copies = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("source", "group", "size", "rate")), strict=True)
            for source, group, size, rate in rows:
                if (source, group) != now:
                    now, owed = (source, group), 0.0
                owed += rate * size
                n = int(rate)
                if n < rate and size and owed - n * size >= size / 2:
                    n += 1
                owed -= n * size
                copies.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(copies, pa.int32())], names=[*names, "copies"])

    order = [F.col("source"), F.col("group"), F.col("size").desc(), F.xxhash64("id", *keys), F.col("id"), *keys]
    return rated.repartition("source", "group").sortWithinPartitions(*order).mapInArrow(diffuse, schema)


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0,
        id_column: str = "doc_id", row_key: bool = False) -> DataFrame:
    """(id, source, size, source_size, target, rate, copies, taken) of every document; ``most`` is a whole number.

    Rows are told apart by id and text; ``row_key`` adds the key of the whole row (row_a, row_b).
    """
    keys = ["row_a", "row_b"] if row_key else ["text_key"]
    told = row_keys(docs) if row_key else [F.xxhash64("text").alias("text_key")]
    sizes = stored(docs.select(F.col(id_column).alias("id"), "source", word_count(F.col("text")).alias("size"), *told))
    rates = stored(balance(source_targets(sizes, weights, share, most)))
    groups = F.greatest(F.lit(1), F.ceil(F.col("rows") / GROUP_ROWS)).cast("long")
    rated = (sizes.join(rates.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
             .withColumn("group", F.pmod(F.xxhash64(F.lit("mix"), "id", *keys), groups)).drop("of", "rows"))
    # A rate above the bound by rounding error is the bound.
    rated = rated.withColumn("rate", F.least(F.col("rate"), F.lit(float(most))))
    snapped = F.when(F.abs(F.col("rate") - F.round("rate")) < 1e-9, F.round("rate")).otherwise(F.col("rate"))
    return round_copies(rated.withColumn("rate", snapped), keys).select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), *(keys if row_key else []))


def row_keys(docs: DataFrame) -> list[Column]:
    """128 bits (row_a, row_b) that stand for a whole row, nulls included."""
    values = [F.col(f"`{c}`") for c in docs.columns]
    parts = [*values, *[v.isNull() for v in values]]
    return [F.xxhash64(*parts).alias("row_a"), F.xxhash64(F.lit("second"), *parts).alias("row_b")]


def mixed_rows(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0,
               id_column: str = "doc_id") -> DataFrame:
    """The rows of the mix, each as often as it is taken; rows alike in all columns share their copies."""
    mixed = mix(docs, weights, share, most, id_column, row_key=True)
    taken = mixed.groupBy("row_a", "row_b").agg(F.sum("copies").alias("copies_")).where("copies_ > 0")
    once = docs.select("*", *row_keys(docs)).dropDuplicates(["row_a", "row_b"])
    return (once.join(taken, ["row_a", "row_b"])
            .withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies_")))).select(*docs.columns))
