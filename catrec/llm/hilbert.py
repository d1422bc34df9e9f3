"""Sharding along a Hilbert curve for multidimensional file pruning.

Language, source and size of a document are quantised to 8 bits each, mapped to
one index on a three-dimensional Hilbert curve, and the documents, sorted by
that index, are cut into runs of near-equal bytes.  Neighbours on the curve are
neighbours in all dimensions, so each shard covers narrow ranges of them.

Equal texts stand together: a group takes the metadata of its first document
(least id) and its text's hash breaks ties of the curve.  A cut that would fall
into a group moves to the group's nearer end if the group is small (at most
1/50 of a shard); larger groups are cut where the law says.

Cases: null text counts no bytes and has the checksum 0 of no bytes; null
language and source take a cell of their own; ties are broken by hash and id;
rows equal in all columns are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import global_order, text_key, widened

BITS = 8
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")
#: Part of a shard that a group of equal texts may take and still move a cut.
SMALL_GROUP = 1 / 50


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of cells (n x dimensions, each below 2^bits)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations of each level
        low = q - 1
        for i in range(dims):
            odd = (x[i] & q) != 0
            swap = np.where(odd, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(odd, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index << 1 | (x[i] >> bit & 1)
    return index


def add_curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("d0", "d1", "d2")], axis=1)
        rest = batch.drop_columns(["d0", "d1", "d2"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(hilbert_index(cells), pa.int64())],
                                         names=[*rest.schema.names, "curve"])


def shard_by_bytes(docs: DataFrame, shards: int, id_column: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, curve) of every document, with the ``carry`` columns.

    ``size`` is the UTF-8 bytes of the text plus 8.  Runs of the curve order are
    cut at equal sums of size; slots count from 0 in curve order.
    """
    text = F.coalesce("text", F.lit(""))
    plain = docs.select(
        F.col(id_column).alias("id"), "lang", "source", F.struct(*(carry or [id_column])).alias("row"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *text_key(F.col("text")))
    # Only texts that occur more than once need their group's metadata.
    groups = (plain.groupBy("key_a", "key_b").agg(F.count("*").alias("copies"),
                                                  F.min(F.struct("id", "lang", "source")).alias("lead"))
              .where("copies > 1").drop("copies"))
    led = plain.join(groups, ["key_a", "key_b"], "left")
    own = lambda name: F.when(F.col("lead").isNull(), F.col(name)).otherwise(F.col("lead")[name])
    cell = lambda c: F.pmod(F.xxhash64(F.coalesce(F.concat(F.lit("="), c), F.lit("null"))), F.lit(1 << BITS))
    scale = F.least(F.floor(F.log2(F.col("size").cast("double")) * 8), F.lit((1 << BITS) - 1)).cast("long")
    placed = led.select("id", "row", "size", "text_crc32", "key_a", "key_b",
                        cell(own("lang")).alias("d0"), cell(own("source")).alias("d1"), scale.alias("d2"))
    schema = widened(placed.drop("d0", "d1", "d2").schema, "curve long")
    ordered, _, total = global_order(placed.mapInArrow(add_curve, schema),
                                     [F.col(c) for c in ("curve", "key_a", "key_b", "id")], "size")
    cuts = move_cuts(ordered, [total * k // shards for k in range(1, shards)], total / shards * SMALL_GROUP)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("before") + F.col("size") / 2 >= F.lit(cut)).cast("int")
    cut_up = ordered.withColumn("shard", shard)
    firsts = cut_up.groupBy("shard").agg(F.min("position").alias("first"))  # one row per shard
    return cut_up.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_column), "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve", *[F.col("row")[c].alias(c) for c in carry or []])


def move_cuts(ordered: DataFrame, cuts: list[int], small: float) -> list[int]:
    """The cuts, moved to the nearer end of a small group of equal texts that they fall into."""
    if not cuts:
        return cuts
    end = F.col("before") + F.col("size")
    across = [(F.col("before") < F.lit(c)) & (end >= F.lit(c)) for c in cuts]
    hit = across[0]
    for one in across[1:]:
        hit = hit | one
    groups = ordered.where(hit).select("key_a", "key_b").distinct()  # at most one group per cut
    spans = (ordered.join(F.broadcast(groups), ["key_a", "key_b"])
             .groupBy("key_a", "key_b").agg(F.min("before").alias("start"), F.max(end).alias("end"))
             .select("start", "end").collect())
    moved = []
    for cut in cuts:
        for span in spans:
            if span["start"] < cut < span["end"] and span["end"] - span["start"] <= small:
                cut = span["start"] if cut - span["start"] <= span["end"] - cut else span["end"]
        moved.append(int(cut))
    return moved
