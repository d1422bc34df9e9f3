"""Merkle dataset manifest by slot pivot.

Every row of a dataset is a leaf.  The leaves of a group (``tree``) are numbered
by a total order, ``fanout`` consecutive nodes become their parent until one
node remains, and the groups' top nodes likewise give one root.  A level is a
pivot: conditional aggregates spread the children of a parent into slot columns;
the hash of all slots concatenated is the parent, all slots but the own one are
the siblings that prove a child.  One pass spreads ``fanout ** LEVELS`` slots and
so climbs ``LEVELS`` levels with one shuffle, whose volume shrinks by that factor
from pass to pass; the way down joins each parent's path to its stored slots.

Nothing is collected but the tallest tree's height.  Keys of shuffles are (group,
block of positions) or (group, range partition), so a group that holds a third
of all rows is spread like any other.

Cases: a null value hashes as ``-``; a null group is a tree of its own and comes
first; null ids come first, equal ids are ordered by their hash, equal rows are
leaves of their own; a row whose number is null can't be tampered with and
proves itself; an empty table gives no rows; other columns, whatever their
names, are left out.  Texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catrec.llm.common import stored

#: Levels that one pass climbs.
LEVELS = 4


def digest(parts: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the parts' texts, one behind the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the value's length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def height_of(n: Column, fanout: int) -> Column:
    """Levels above the leaves until one node remains."""
    powers = [fanout ** h for h in range(62) if fanout ** h < 1 << 62]
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < n))


def numbered(leaves: DataFrame, order: Sequence[str], fanout: int) -> DataFrame:
    """``leaves`` (tree, item, order columns) -> (tree, height, pos, item), stored.

    Rows are dealt by range; a tree's offset in a partition is a sum over the
    trees' parts, of which there are no more than partitions and trees together.
    ``order`` ends in a column that tells rows apart.
    """
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c) for c in ("tree", *order)]
    placed = stored(leaves.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                    .select("tree", "item", F.monotonically_increasing_id().alias("place"))
                    .withColumn("part", F.shiftright("place", 33)))
    ends = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree")
    ahead = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("tree", "part", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
                          height_of(F.sum("n").over(of_tree), fanout).alias("height"))
    return stored(placed.join(offsets, ["tree", "part"]).select(
        "tree", "height", (F.col("place") - F.col("first") + F.col("ahead")).alias("pos"), "item"))


def slot(i: int) -> str:
    return f"slot_{i}"


def node(level: int, i: int) -> str:
    return f"node_{level}_{i}"


def hash_at(level: int, i: int) -> Column:
    return F.col(node(level, i)) if level else F.col(slot(i))["hash"]


def spread(nodes: DataFrame, base: int, fanout: int) -> DataFrame:
    """One row for each ancestor ``LEVELS`` up: its slots at level ``base`` and the nodes between."""
    width = fanout ** LEVELS
    here = F.pmod("pos", F.lit(width))
    wide = nodes.groupBy("tree", "height", F.expr(f"pos div {width}").alias("pos")).agg(
        *[F.max(F.when(here == i, F.col("item"))).alias(slot(i)) for i in range(width)])
    for level in range(1, LEVELS + 1):
        made = {}
        for i in range(width // fanout ** level):
            children = [hash_at(level - 1, i * fanout + k) for k in range(fanout)]
            hashed = digest([F.coalesce(c, F.lit("")) for c in children])
            made[node(level, i)] = (F.when(F.col(slot(i * fanout ** level)).isNull(), F.lit(None))
                                    .when(F.col("height") < base + level, children[0]).otherwise(hashed))
        wide = wide.withColumns(made)
    return wide


def climb(leaves: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored passes from the leaves up, and (tree, hash) of each tree's top."""
    tallest = leaves.agg(F.max("height")).first()[0] or 0
    passes, tops, nodes = [], None, leaves
    for base in range(0, max(tallest, 1), LEVELS):
        wide = stored(spread(nodes, base, fanout))
        top = F.col(node(LEVELS, 0))
        done = wide.where(F.col("height") <= base + LEVELS).select("tree", top.alias("hash"))
        tops = done if tops is None else tops.union(done)
        nodes = wide.where(F.col("height") > base + LEVELS).select("tree", "height", "pos", F.struct(top.alias("hash")).alias("item"))
        passes.append(wide)
    return passes, tops


def siblings(i: int, fanout: int) -> Column:
    """(left, right) of slot ``i`` at each level of a pass: its run without the own slot column."""
    steps = []
    for level in range(LEVELS):
        own = i // fanout ** level
        run = own - own % fanout
        side = lambda a, b: F.concat(F.lit(""), *[F.coalesce(hash_at(level, x), F.lit("")) for x in range(a, b)])  # noqa: B023, E731
        steps.append(F.struct(side(run, own).alias("left"), side(own + 1, run + fanout).alias("right")))
    return F.array(*steps)


def descend(passes: list[DataFrame], outer: DataFrame, fanout: int) -> DataFrame:
    """Every leaf's ``path`` of siblings up to its tree's top, followed by the tree's own in ``outer``
    (tree, path, above): rows (tree, item, path, above)."""
    width = fanout ** LEVELS
    children = None
    for k in reversed(range(len(passes))):
        base, wide = k * LEVELS, passes[k]
        framed = wide.where(F.col("height") <= base + LEVELS).join(outer, "tree")
        if children is not None:
            inner = wide.where(F.col("height") > base + LEVELS).join(children.drop("item"), ["tree", "pos"])
            framed = framed.unionByName(inner)
        used = F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.col("height") - base))
        slots = F.array(*[F.struct(F.lit(i).alias("i"), F.col(slot(i)).alias("item"), siblings(i, fanout).alias("steps"))
                          for i in range(width)])
        rows = framed.select("tree", "pos", "path", "above", used.alias("used"), F.explode(slots).alias("s"))
        children = rows.where(F.col("s.item").isNotNull()).select(
            "tree", (F.col("pos") * width + F.col("s.i")).alias("pos"), F.col("s.item").alias("item"),
            F.concat(F.slice("s.steps", F.lit(1), F.col("used")), "path").alias("path"), "above")
    return children.drop("pos")


def manifest(rows: DataFrame, columns: Sequence[str], tree: str, order: str, tampered: dict[str, Column] | None = None,
             tamper: Column | None = None, fanout: int = 2) -> DataFrame:
    """The leaves with their proofs: ``order`` column, leaf, tampered_leaf, subroot, root, path.

    ``columns`` are hashed in their order.  Where ``tamper`` holds, tampered_leaf
    is the hash with the columns of ``tampered`` replaced, else the leaf itself.
    ``path`` lists (left, right) siblings from the leaf to the root.
    """
    leaf = digest([field(F.col(c)) for c in columns])
    changed = F.lit(None).cast("string")
    if tampered and tamper is not None:
        changed = F.when(tamper, digest([field(tampered.get(c, F.col(c))) for c in columns]))
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))  # null first, then bytewise
    hashed = stored(rows.select(key.alias("tree"), F.col(order).alias("id"), leaf.alias("hash"), changed.alias("changed"),
                                F.monotonically_increasing_id().alias("row")))
    leaves = hashed.select("tree", F.struct("hash", "changed", "id").alias("item"), "id", "hash", "row")
    passes, tops = climb(numbered(leaves, ["id", "hash", "row"], fanout), fanout)
    groups = tops.select(F.lit("").alias("tree"), F.col("tree").alias("row"), F.struct("hash", "tree").alias("item"))
    over, top = climb(numbered(groups, ["row"], fanout), fanout)
    none = F.array().cast("array<struct<left:string,right:string>>")
    ends = descend(over, top.select("tree", none.alias("path"), F.col("hash").alias("above")), fanout)
    outer = ends.select(F.col("item.tree").alias("tree"), "path",
                        F.struct(F.col("item.hash").alias("subroot"), F.col("above").alias("root")).alias("above"))
    proved = descend(passes, stored(outer), fanout)
    return proved.select(F.col("item.id").alias(order), F.col("item.hash").alias("leaf"),
                         F.coalesce("item.changed", "item.hash").alias("tampered_leaf"), "above.subroot", "above.root", "path")


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))
