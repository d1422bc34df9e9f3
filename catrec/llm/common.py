"""Helpers shared by the operators: stored intermediates, components, global order.

Intermediates that feed several jobs are written as Parquet below the shared
folder of ``spark.checkpoint.dir`` (:func:`stored`), so a lost executor costs
a re-read; those that nothing reads again are deleted (:func:`released`).  Nothing here collects rows whose number grows with the data; the
driver sees one row per partition at most.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catrec.sinks.fs import delete

#: Bytes of text that a Python task holds as objects at a time (whole documents).
CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 8192
#: Buckets up to this size have all pairs between their classes verified.
SMALL_BUCKET = 64
#: Lets a job's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of our own only where none is set and all runs on one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="catrec-", dir="/tmp"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back (lineage is cut)."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_path = path
    return kept


def lean(df: DataFrame) -> DataFrame:
    """``stored``, and the shuffle files of its job go with it."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        return stored(df)
    finally:
        spark.conf.set(CLEANUP, before)


def released(*frames: DataFrame) -> None:
    """Deletes the files of stored frames that no later job reads."""
    for frame in frames:
        delete(frame.sparkSession, *frame.stored_path.rsplit("/", 1))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of whole rows of about ``limit`` bytes of ``column``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit or i - start >= CHUNK_ROWS:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def widened(schema: StructType, ddl: str) -> StructType:
    """``schema`` with the columns of ``ddl`` behind its own."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a whole text (two seeds of xxhash64)."""
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit("second"), text).alias("key_b")]


def connected_components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(id, root) for every end of an edge; root is the least id of its component.

    Least labels travel along the edges and are shortened by pointer jumping,
    so a chain of n nodes takes about log n rounds and a star two.  Labels are
    stored after each round.  Minima combine map-side; only joins meet a hub
    with many edges, and adaptive execution splits those.
    """
    pairs = edges.select(F.col(first).alias("src"), F.col(second).alias("dst")).where("src <> dst")
    both = lean(pairs.union(pairs.select("dst", "src")).distinct())
    last = lean(both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("near"))
                    .select("id", F.least("id", "near").alias("root")))
    labels = last
    while True:
        near = (both.join(labels.select(F.col("id").alias("dst"), F.col("root").alias("reach")), "dst")
                .groupBy(F.col("src").alias("id")).agg(F.min("reach").alias("reach")))
        hooked = labels.join(near, "id").select("id", F.col("root").alias("old"),
                                                F.least("root", "reach").alias("step"))
        up = labels.select(F.col("id").alias("step"), F.col("root").alias("above"))
        moved = lean(hooked.join(up, "step").select("id", "old", F.least("step", "above").alias("root")))
        released(last)
        last, labels = moved, moved.select("id", "root")
        if moved.where("root < old").isEmpty():
            released(both)
            return labels


def global_order(df: DataFrame, order: list[Column], value: str) -> tuple[DataFrame, int, int]:
    """``df`` in one total order: adds ``position`` and ``before`` (sum of ``value`` of the rows ahead).

    Returns the stored frame, the number of rows and the sum.  Rows are dealt
    by range and numbered inside each partition; one row per partition (not
    per key) reaches the driver to set the offsets.  ``order`` must end in a
    column that tells rows apart, then no key can fill a partition.
    """
    spark = df.sparkSession
    names = df.columns
    schema = widened(df.schema, "part int, position long, before long")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part, rows, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sums = np.cumsum(batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64))
            n = batch.num_rows
            before = np.concatenate([[0], sums[:-1]]) + total if n else sums
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows, rows + n)),
                 pa.array(before.astype(np.int64))], names=[*names, "part", "position", "before"])
            rows, total = rows + n, total + int(sums[-1]) if n else total

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = stored(dealt.mapInArrow(number, schema))
    ends = (numbered.groupBy("part").agg(F.count("*").alias("rows"), F.sum(value).alias("total"))
            .orderBy("part").collect())  # one row per partition
    offsets, rows, total = [], 0, 0
    for end in ends:
        offsets.append((end["part"], rows, total))
        rows, total = rows + end["rows"], total + int(end["total"])
    if not offsets:
        return numbered.drop("part"), 0, 0
    shift = F.broadcast(spark.createDataFrame(offsets, "part int, rows_ahead long, sum_ahead long"))
    placed = numbered.join(shift, "part").withColumns(
        {"position": F.col("position") + F.col("rows_ahead"), "before": F.col("before") + F.col("sum_ahead")})
    return placed.drop("part", "rows_ahead", "sum_ahead"), rows, total


def joined_roots(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Classes (id, root) after further ``links``: only the linked classes are walked again."""
    if roots is None:
        return connected_components(links)
    ends = links
    for end in ("a", "b"):
        near = roots.select(F.col("id").alias(end), F.col("root").alias("near"))
        ends = ends.join(near, end, "left").withColumn(end, F.coalesce("near", end)).drop("near")
    merged = connected_components(ends)
    moved = roots.join(merged.select(F.col("id").alias("root"), F.col("root").alias("above")), "root", "left").select(
        "id", F.coalesce("above", "root").alias("root"))
    return lean(moved.union(merged.join(roots, "id", "left_anti").select("id", "root")))


def class_leads(groups: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``groups`` (id, lead, ...) with ``class_lead``, the least lead among the groups under one root of ``roots``."""
    if roots is None:
        return groups.withColumn("class_lead", F.col("lead"))
    rooted = groups.join(roots, "id", "left")
    least = (rooted.where("root is not null").groupBy("root").agg(F.min("lead").alias("least")))
    return rooted.join(least, "root", "left").select(
        *groups.columns, F.coalesce("least", "lead").alias("class_lead"))


def hub_links(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame],
              compare: Callable[[DataFrame], DataFrame], ratio: float = 0.0) -> DataFrame | None:
    """Classes by the verified links among the members of buckets.

    ``buckets`` (bucket, id): distinct candidate memberships, stored, only buckets
    of two and more; ``verify`` keeps the true pairs of a frame (a, b).  The least
    id of a bucket is compared with all others first; members that then share a
    class need no more comparisons, so a group of copies costs as many pairs as
    it has members.  Of buckets that still hold several classes, those of up to
    ``SMALL_BUCKET`` members have all pairs between classes verified (at most
    half that number for each membership).  The larger ones are handed to
    ``compare``, which takes rows (bucket, id, root) and returns the true pairs
    (a, b) between their classes.  With a ``ratio``, ``buckets`` also has ``least``
    and ``most``, bounds of a member's size; pairs of which no two sizes within
    them have that ratio are none and not verified.

    Returns (id, root) for the linked ids, or None where there is no link.
    """
    bounds = ["least", "most"] if ratio else []

    def fits(one: str, other: str) -> Column:
        near = [F.col(x + "most") >= ratio * F.col(y + "least") for x, y in ((one, other), (other, one))]
        return near[0] & near[1] if ratio else F.lit(True)

    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("a"), *[F.min_by(c, "id").alias(f"a_{c}") for c in bounds])
    tested = lean(buckets.join(hubs, "bucket").where((F.col("a") < F.col("id")) & fits("a_", ""))
                  .select("a", F.col("id").alias("b")).distinct())
    found = lean(verify(tested))
    roots = None if found.isEmpty() else joined_roots(None, found)
    released(found)
    named = buckets.withColumn("root", F.col("id")) if roots is None else (
        buckets.join(roots, "id", "left").select("bucket", "id", *bounds, F.coalesce("root", "id").alias("root")))
    still = (named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
             .where("low < high and n > 2").select("bucket", "n"))
    left = lean(named.join(still, "bucket"))
    small = left.where(F.col("n") <= SMALL_BUCKET).select("bucket", "id", "root", *bounds)
    others = small.select("bucket", F.col("id").alias("b"), F.col("root").alias("root_b"),
                          *[F.col(c).alias(f"b_{c}") for c in bounds])
    more = small.join(others, "bucket").where((F.col("id") < F.col("b")) & (F.col("root") != F.col("root_b")) & fits("", "b_"))
    more = lean(more.select(F.col("id").alias("a"), "b").distinct().join(tested, ["a", "b"], "left_anti"))
    released(tested)
    large = left.where(F.col("n") > SMALL_BUCKET).select("bucket", "id", "root")
    near = lean(verify(more))
    released(more)
    far = lean(compare(large))
    released(left)
    found = near.union(far).distinct()
    if not found.isEmpty():
        roots = joined_roots(roots, found)
    released(near, far)
    return roots
