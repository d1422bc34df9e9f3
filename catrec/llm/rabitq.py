"""Embedding near-dedup with randomised-rotation binary codes.

Equal vectors are collapsed first.  Each vector gets a bucket in several tables:
the largest coordinates of independently rotated copies (as many rotations per
table as the number of vectors asks for, as many tables as the wished recall at
the threshold asks for).  Inside a bucket a vector is a code, the signs of its
rotated coordinates, and a correction factor, the inner product of the unit
vector with its code.  Code and 4-bit query give an unbiased estimate of the
inner product; where the estimate plus its confidence bound reaches the
threshold, the cosine is recomputed in double precision.  Nothing below the
threshold is linked.

Buckets of any size are dealt as pairs of blocks, so no task holds a whole one;
a task returns one row per vector, not per pair: its links and the least vector
it reaches there.  A pair that meets in several tables counts in the first.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of different lengths don't link; equal vectors link
with each other; rows that repeat an id count as vectors of their own.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import class_leads, connected_components, stored, text_key

THRESHOLD = 0.9
#: Wished share of the pairs at the threshold that meet in a bucket (above it more do).
RECALL = 0.985
#: Vectors that share a bucket by chance, about.
BUCKET_ROWS = 16
#: Vectors of a block of a large bucket.
BLOCK_ROWS = 256
#: Candidate pairs that a task holds at a time.
PAIRS = 1 << 17
#: Standard deviations of the estimate that a pair may lie below the threshold and still be recomputed.
CONFIDENCE = 5.0
QUERY_BITS = 4
#: More tables than this are refused (their rotations would not fit beside a task's work).
MOST_TABLES = 400


@functools.lru_cache(maxsize=8)
def layout(dims: int, vectors: int, threshold: float) -> tuple[np.ndarray, int, int]:
    """(rotations, tables, rotations per table)."""
    draw = np.random.default_rng(dims)
    one = draw.standard_normal((20_000, dims))
    two = threshold * one + math.sqrt(1 - threshold * threshold) * draw.standard_normal((20_000, dims))
    top = [np.abs(x).argmax(1) for x in (one, two)]
    rows = np.arange(len(one))
    same = np.mean((top[0] == top[1]) & (np.sign(one[rows, top[0]]) == np.sign(two[rows, top[1]])))
    deep = max(1, round(math.log(max(2.0, vectors / BUCKET_ROWS)) / math.log(2 * dims + 1)))
    tables = max(2, math.ceil(math.log(1 - RECALL) / math.log(1 - min(same ** deep, 0.999))))
    if tables > MOST_TABLES:
        raise ValueError(f"{vectors} vectors of {dims} dimensions at {threshold} need {tables} tables, over {MOST_TABLES}")
    rotations = np.stack([np.linalg.qr(draw.standard_normal((dims, dims)))[0] for _ in range(tables * deep)])
    return rotations.astype(np.float32), tables, deep


@functools.lru_cache(maxsize=8)
def code_rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng([dims, 1]).standard_normal((dims, dims)))[0].astype(np.float32)


def unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(1, keepdims=True))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    width = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, width))), axis=1).view(np.uint64)


def encode(vectors: np.ndarray, total: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket keys by table, codes, correction factors) of vectors of one length."""
    dims = vectors.shape[1]
    rotations, tables, deep = layout(dims, total, threshold)
    flat = unit(vectors).astype(np.float32)
    turned = flat @ code_rotation(dims)
    codes, factors = packed(turned > 0), np.abs(turned).sum(1) / math.sqrt(dims)
    keys = np.full((len(flat), tables), dims, np.int64)
    for t in range(tables):
        for r in range(deep):
            x = flat @ rotations[t * deep + r]
            top = np.abs(x).argmax(1)
            keys[:, t] = keys[:, t] * (2 * dims + 1) + 2 * top + (x[np.arange(len(x)), top] > 0)
        keys[:, t] = keys[:, t] * 1009 + t
    return keys, codes, factors


class Members:
    """Rows of one length of many pairs of blocks, in order of group and own block; all groups are compared at once."""

    def __init__(self, rows: pa.RecordBatch, kind: str, threshold: float):
        whole = {c: rows.column(c).to_numpy(zero_copy_only=False) for c in
                 ("id", "copies", "bucket", "low", "high", "own", "factor")}
        self.ids, self.copies, self.bucket, self.factors = (whole[c] for c in ("id", "copies", "bucket", "factor"))
        n = rows.num_rows
        self.keys = rows.column("keys").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        self.codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(n, -1)
        self.flat = unit(np.frombuffer(b"".join(rows.column("vector").to_pylist()), kind).reshape(n, -1))
        self.threshold = threshold
        # Partners of a row: the later rows of its group if it pairs a block with itself, else the other block's rows.
        ends = np.append(np.flatnonzero(changes([whole[c] for c in ("bucket", "low", "high")])), n)
        end = np.repeat(ends[1:], np.diff(ends))
        blocks = np.append(np.flatnonzero(changes([whole[c] for c in ("bucket", "low", "high", "own")])), n)
        other = np.repeat(blocks[1:], np.diff(blocks))
        self.first = np.where(whole["low"] == whole["high"], np.arange(n) + 1,
                              np.where(whole["own"] == whole["low"], other, end))
        self.partners = end - self.first
        self._queries()

    def _queries(self) -> None:
        """Each row as a query of QUERY_BITS bits a dimension: bit planes, and what the estimate needs of it."""
        dims = self.flat.shape[1]
        query = self.flat.astype(np.float32) @ code_rotation(dims)
        self.least = query.min(1)
        self.step = np.maximum((query.max(1) - self.least) / (2 ** QUERY_BITS - 1), 1e-12)
        levels = np.rint((query - self.least[:, None]) / self.step[:, None]).astype(np.uint8)
        self.planes = [packed(levels >> bit & 1) for bit in range(QUERY_BITS)]
        self.total = self.least * dims + self.step * levels.sum(1)
        self.ones = np.bitwise_count(self.codes).sum(1).astype(np.float32)
        self.spread = (np.sqrt(np.maximum(1 - self.factors ** 2, 0)) / self.factors
                       / math.sqrt(max(dims - 1, 1))).astype(np.float32)

    def likely(self, coded: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Mask of the pairs (code, query) whose estimate plus its bound reaches the threshold."""
        summed = np.zeros(len(coded), np.float32)
        for bit, plane in enumerate(self.planes):
            summed += np.float32(2 ** bit) * np.bitwise_count(self.codes[coded] & plane[asked]).sum(1)
        signed = 2 * (self.least[asked] * self.ones[coded] + self.step[asked] * summed) - self.total[asked]
        estimate = signed / math.sqrt(self.flat.shape[1]) / self.factors[coded]
        bound = CONFIDENCE * (self.spread[coded] + 0.3 * self.step[asked] / self.factors[coded])
        return estimate + bound >= self.threshold

    def linked(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The linked pairs of rows, in runs of about PAIRS candidates; each pair in the first table that both share."""
        before = np.append(0, np.cumsum(self.partners))
        start = 0
        while start < len(self.partners):
            stop = max(start + 1, int(np.searchsorted(before, before[start] + PAIRS, "right")) - 1)
            left = np.repeat(np.arange(start, stop), self.partners[start:stop])
            right = self.first[left] + np.arange(len(left)) - (before[left] - before[start])
            near = self.likely(left, right)
            near[~near] = self.likely(right[~near], left[~near])
            left, right = left[near], right[near]
            here = self.keys[left, (self.keys[left] == self.keys[right]).argmax(1)] == self.bucket[left]
            left, right = left[here], right[here]
            same = np.einsum("ij,ij->i", self.flat[left], self.flat[right]) >= self.threshold
            yield left[same], right[same]
            start = stop

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, copies linked, least id reached in its group) of the rows that have links."""
        runs = list(self.linked())
        a, b = (np.concatenate([run[side] for run in runs]) for side in (0, 1))
        count = np.zeros(len(self.ids), np.int64)
        np.add.at(count, a, self.copies[b])
        np.add.at(count, b, self.copies[a])
        root = self.ids.copy()
        while len(a):
            before = root.copy()
            least = np.minimum(root[a], root[b])
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
            if (root == before).all():
                break
        some = np.flatnonzero(count)
        return self.ids[some], count[some], root[some]


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """Mask of the rows at which any of the columns differs from the row before; the first row counts."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    kind = "<f8" if "double" in vectors.schema[vector_column].dataType.simpleString() else "<f4"
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    sound = (F.col("vector").isNotNull() & (F.size("vector") > 0)
             & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
             & F.exists("vector", lambda x: x != 0))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    # Equal vectors are one group under a number of its own, whatever ids they have.
    groups = stored(rows.where("sound").withColumns(dict(zip(("key_a", "key_b"), text_key(F.col("vector")), strict=True)))
                    .groupBy("key_a", "key_b").agg(F.min("id").alias("lead"), F.count("*").alias("copies"),
                                                   F.first("vector").alias("vector"))
                    .withColumn("id", F.monotonically_increasing_id()))
    total = groups.count()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("vector")
            sizes = np.diff(listed.offsets.to_numpy())
            flat = listed.flatten().to_numpy(zero_copy_only=False).astype(kind)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                block = flat[(starts[at][:, None] + np.arange(dims)[None]).ravel()].reshape(len(at), dims)
                keys, codes, factors = encode(block, total, threshold)
                picked = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [picked.column("id"), picked.column("copies"), pa.array(list(keys), pa.list_(pa.int64())),
                     pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(factors, pa.float32()),
                     pa.array([x.tobytes() for x in block], pa.binary())],
                    names=["id", "copies", "keys", "code", "factor", "vector"])

    codes = stored(groups.select("id", "copies", "vector").mapInArrow(
        coded, "id long, copies long, keys array<long>, code binary, factor float, vector binary"))
    # Buckets of two and more, and the number of blocks that each is cut into.
    sizes = (codes.select(F.explode("keys").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
             .where("n > 1").select("bucket", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")))
    placed = (codes.select("*", F.explode("keys").alias("bucket")).join(sizes, "bucket")
              .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own",
                      "id", "copies", "keys", "code", "factor", "vector"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            lengths = pc.binary_length(rows.column("vector")).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                alike = Members(rows.take(pa.array(np.flatnonzero(lengths == length))), kind, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in alike.links()],
                                                 names=["id", "links", "root"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            # The last group may go on in the next batch.
            groups = np.flatnonzero(changes([rows.column(c).to_numpy(zero_copy_only=False)
                                             for c in ("bucket", "low", "high")]))
            held = rows.slice(groups[-1])
            if groups[-1]:
                yield from result(rows.slice(0, groups[-1]))
        if held is not None:
            yield from result(held)

    near = stored(placed.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "own")
                  .mapInArrow(compared, "id long, links long, root long"))
    links = near.groupBy("id").agg(F.sum("links").alias("links"))
    roots = connected_components(near.select("id", "root"), "id", "root")
    classes = class_leads(groups.select("key_a", "key_b", "id", "lead", "copies"), roots).join(links, "id", "left")
    named = rows.select("id", *[F.when(F.col("sound"), k).alias(n) for n, k in
                                zip(("key_a", "key_b"), text_key(F.col("vector")), strict=True)])
    component = F.coalesce("class_lead", "id")
    return named.join(classes.drop("id"), ["key_a", "key_b"], "left").select(
        F.col("id").alias(id_column),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("id") == component).alias("kept"))
