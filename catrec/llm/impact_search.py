"""Ranked lexical search by dense blocked matrix products over integer impacts.

A document's score for an item is a sum of integers: the weight of a term times
its impact in the document.  The items are taken in blocks of bounded bytes.  For
a block, one pass over the documents counts the block's terms in each text; from
those counts come the statistics over all documents and, in a second pass, tiles:
items x compact vocabulary times vocabulary x documents, in float64.  A tile
holds only terms that its items share with its documents, and never so many that
a sum could reach 2^53, so every product is an exact integer; sums over several
vocabulary tiles are carried on in int64.

Each task reads its documents by ascending id and keeps the best ``k`` of every
item; an equal score that comes later has the greater id and loses, so ties never
pile up.  A task sends at most ``k`` rows an item, and the last step ranks those.

Cases: a null text and one without terms match nothing and don't count in N; an
item without terms gives no rows; each row of the items is an item of its own,
with whatever id it has; equal scores go by ascending doc_id, null ids first;
rows that share an id are ranked as rows; an empty table gives no rows; other
columns, whatever their names, are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catrec.llm.common import global_order, stored, text_chunks, widened

#: Bytes of distinct terms of the items that are searched in one pass over the documents.
BLOCK_BYTES = 4 << 20
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 256, 2048, 1024
#: Impacts stay below this: (10^9 tf) div (1000 tf + 8 m).
IMPACT_BOUND = 1_000_000
EXACT = 1 << 53

#: Letters, digits and all bytes of characters beyond ASCII stay (A-Z as a-z); the rest is space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def item_terms(items: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item, terms, bytes, row) of each item that has terms; its distinct terms in order."""
    source = items.select(F.col(item_column).alias("item"), F.col(text_column).cast("binary").alias("text"),
                          F.monotonically_increasing_id().alias("row"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            sets = [sorted(set(terms_of(x))) for x in chunk.column("text").to_pylist()]
            sizes = [sum(map(len, x)) + len(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("item"), pa.array(sets, pa.list_(pa.binary())), pa.array(sizes, pa.int64()), chunk.column("row")],
                names=["item", "terms", "bytes", "row"])

    schema = widened(source.select("item").schema, "terms array<binary>, bytes long, row long")
    return stored(source.mapInArrow(distinct, schema).where("bytes > 0"))


def count_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc, n, cols, tfs) of ``docs`` (doc, text): all terms, and the counts of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(shared.value)}
        for chunk in text_chunks(batches, "text"):
            totals, ends, cols, tfs = [], [0], [], []
            for text in chunk.column("text").to_pylist():
                terms = terms_of(text)
                counts = Counter(terms)
                found = [(number[t], tf) for t, tf in counts.items() if t in number]
                totals.append(len(terms))
                cols += [c for c, _ in found]
                tfs += [tf for _, tf in found]
                ends.append(len(cols))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc"), pa.array(totals, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(cols, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], names=["doc", "n", "cols", "tfs"])

    schema = widened(docs.select("doc").schema, "n long, cols array<int>, tfs array<long>")
    return stored(docs.mapInArrow(count, schema))


class Best:
    """The ``k`` best (score, id) of each item; rows stand by falling score, then by arrival."""

    def __init__(self, items: int, k: int):
        self.k, self.scores, self.ids = k, np.zeros((items, k), np.int64), np.full((items, k), None, object)

    def offer(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` (items from ``first`` on x documents), documents by ascending id behind all earlier ones."""
        better = scores > self.scores[first:first + len(scores), -1:]
        for i in np.flatnonzero(better.any(axis=1)):
            at = np.flatnonzero(better[i])
            both = np.concatenate([self.scores[first + i], scores[i, at]])
            top = np.argsort(-both, kind="stable")[:self.k]
            self.scores[first + i] = both[top]
            self.ids[first + i] = np.concatenate([self.ids[first + i], ids[at]])[top]


def scored_tiles(docs: DataFrame, item_cols: list[np.ndarray], weights: np.ndarray, k: int) -> DataFrame:
    """(number, doc, score): the best ``k`` of each task's documents for each item.

    ``docs`` (doc, m, cols, tfs); ``item_cols`` are the items' term numbers, ``weights`` the terms' weights.
    """
    width = max(1, min(TILE_TERMS, (EXACT - 1) // (max(1, int(weights.max())) * IMPACT_BOUND)))
    shared = docs.sparkSession.sparkContext.broadcast((item_cols, weights))

    def vocabulary_tiles(cols: list[np.ndarray], weights: np.ndarray) -> Iterator[tuple]:
        """For each tile of items: its first item, their number, and tiles (terms, positions, items) of its vocabulary."""
        for first in range(0, len(cols), TILE_ITEMS):
            part = cols[first:first + TILE_ITEMS]
            owner, term = np.repeat(np.arange(len(part)), [len(x) for x in part]), np.concatenate(part)
            terms, at = np.unique(term, return_inverse=True)
            tiles = []
            for low in range(0, len(terms), width):
                mine = (at >= low) & (at < low + width)
                tiles.append((terms[low:low + width], at[mine] - low, owner[mine]))
            yield first, len(part), tiles

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols, weights = shared.value
        plan, best = list(vocabulary_tiles(cols, weights)), Best(len(cols), k)
        kind = None
        for batch in batches:
            kind = batch.column("doc").type
            for start in range(0, batch.num_rows, TILE_DOCS):
                tile = batch.slice(start, TILE_DOCS)
                ids = np.empty(tile.num_rows, object)
                ids[:] = tile.column("doc").to_pylist()
                lists = tile.column("cols")
                doc = np.repeat(np.arange(tile.num_rows), lists.value_lengths().to_numpy())
                term, tf = lists.flatten().to_numpy(), tile.column("tfs").flatten().to_numpy()
                m = tile.column("m").to_numpy()
                impact = (1_000_000_000 * tf // (1000 * tf + 8 * m[doc])).astype(np.float64)
                for first, n, tiles in plan:
                    total = np.zeros((n, tile.num_rows), np.int64)
                    for terms, at, owner in tiles:
                        place = np.searchsorted(terms, term)
                        place[place == len(terms)] = 0
                        hit = terms[place] == term
                        used = np.zeros(len(terms), bool)
                        used[place[hit]] = True
                        row = np.cumsum(used) - 1
                        right = np.zeros((int(used.sum()), tile.num_rows))
                        right[row[place[hit]], doc[hit]] = impact[hit]
                        left, mine = np.zeros((n, len(right))), used[at]
                        left[owner[mine], row[at[mine]]] = weights[terms[at[mine]]]
                        total += (left @ right).astype(np.int64)
                    best.offer(first, total, ids)
        item, place = np.nonzero(best.scores)
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)), pa.array(best.ids[item, place].tolist(), kind),
                 pa.array(best.scores[item, place])], names=["number", "doc", "score"])

    schema = widened(docs.select(F.lit(0).alias("number"), "doc").schema, "score long")
    return docs.sortWithinPartitions("doc").mapInArrow(multiply, schema)


def best_documents(docs: DataFrame, items: DataFrame, k: int = 10, doc_column: str = "doc_id",
                   item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item, rank, doc, score): each item's ``k`` best documents with a score above 0, under their own column names.

    The driver sees one block of items (``BLOCK_BYTES``, or one item that is
    longer) and the document counts of its terms at a time.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_column).alias("doc"), F.col(text_column).cast("binary").alias("text"))
    ordered, _, total = global_order(item_terms(items, item_column, text_column), [F.col("row")], "bytes")
    ordered = stored(ordered.withColumn("block", F.expr(f"before div {BLOCK_BYTES}")))
    blocks = [r["block"] for r in ordered.select("block").distinct().orderBy("block").collect()]
    out = None
    for block in blocks:
        mine = ordered.where(F.col("block") == block)
        wanted = mine.orderBy("position").select("position", "terms").collect()
        vocabulary = sorted({bytes(t) for item in wanted for t in item["terms"]})
        number = {term: i for i, term in enumerate(vocabulary)}
        item_cols = [np.sort(np.array([number[bytes(t)] for t in item["terms"]], np.int32)) for item in wanted]
        counted = count_terms(source, vocabulary)
        held, length = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        found = counted.select(F.explode("cols").alias("term")).groupBy("term").count().collect()  # one row a term of the block
        weights = np.zeros(len(vocabulary), np.int64)
        for row in found:
            weights[row["term"]] = math.floor(1000 * math.log((2 * held + 2) / (2 * row["count"] + 1)))
        rated = counted.where(F.size("cols") > 0).select(
            "doc", F.expr(f"10 + (90L * n * {held}L) div {max(length, 1)}L").alias("m"), "cols", "tfs")
        mark = spark.createDataFrame([(i, item["position"]) for i, item in enumerate(wanted)], "number int, position long")
        best = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc"))
        top = (scored_tiles(rated, item_cols, weights, k).withColumn("rank", F.row_number().over(best))
               .where(F.col("rank") <= k).join(mark, "number").join(mine.select("position", "item"), "position")
               .select(F.col("item").alias(item_column), "rank", F.col("doc").alias(doc_column), "score"))
        top = top if len(blocks) == 1 else stored(top)
        out = top if out is None else out.union(top)
    if out is None:
        fields = [*widened(items.select(item_column).schema, "rank int").fields, *docs.select(doc_column).schema.fields]
        return spark.createDataFrame([], widened(StructType(fields), "score long"))
    return out
