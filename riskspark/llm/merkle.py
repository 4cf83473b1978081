"""A Merkle manifest of a table, with an inclusion proof for every row by pointer jumping.

Every row is a leaf: the SHA-256 (lowercase hex) of its fields, each as UTF-8 byte count, ``:``
and value, or ``-`` if null. The leaves of a partition value (``lang``) ascend by id; runs of
``fanout`` consecutive nodes become the hash of their digests, level by level, until one is left,
the subroot. The subroots, ordered by the partition value, become the root in the same way.

Proofs: every node starts with the segment of its siblings towards its parent. Then the table of
nodes is joined with itself: a node takes over the pointer of the node that it points to, and
appends that node's segment to its own. Each join doubles the distance, so that after as many as
the logarithm of the tree's height all leaves point past the root. The table that a join looks up
in has only the nodes that the distance still reaches, so that it gets ``fanout`` times smaller
with every level, and the texts are read once and never shuffled.

Positions come from a range partitioning by partition value and id, so that a value with most
rows is spread like any other; the last joins, to the few nodes far above the leaves, send that
small side to all tasks where its size, known from the counts, is below ``SMALL_NODES`` rows.

Defined results: null ids come first, rows with equal ids are ordered by their leaves (equal rows
are equal leaves, each with its own proof). A null partition value is a value of its own and comes
first. A table of one row has that leaf as its root and an empty proof; an empty table gives an
empty table. A field of any type counts as its text in Spark. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.stage import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SMALL_NODES = 1 << 16  # of about 64 * fanout bytes and more each
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEGMENT = "array<struct<l: binary, r: binary>>"


def leaf_digest(values: list[Column]) -> Column:
    """The digest of a row's fields, in order."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined(digests: Column) -> Column:
    """An array of binary digests as one binary value."""
    return F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d))


def _node(tree: Column, level: Column | int, pos: Column) -> Column:
    """The name of a node: its tree (the rank of the partition value; -1 for the tree of subroots), level and position."""
    level = F.lit(level) if isinstance(level, int) else level
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))


def _placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 within the group) and ``size`` of the group, by ``order``; any group is spread over ranges."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.asc_nulls_first(c) for c in (group, *order)]
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    dealt = staged(dealt.withColumns({"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}), "places")
    # One row for each range and group: a group's rows before a range, and its first place in the range.
    counts = dealt.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    within = Window.partitionBy(group)
    before = F.sum("_n").over(within.orderBy("_part")) - F.col("_n")
    counts = counts.select(F.col("_part").alias("_p"), F.col(group).alias("_g"), (before - F.col("_first")).alias("_shift"), F.sum("_n").over(within).alias("size"))
    counts = staged(counts, "ranges")
    return (dealt.join(counts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
            .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_p", "_g", "_shift"))


def _height(size: int, fanout: int) -> int:
    """The levels above ``size`` nodes."""
    levels = 0
    while size > 1:
        size, levels = -(-size // fanout), levels + 1
    return levels


def _tree(nodes: DataFrame, height: int, fanout: int, last) -> tuple[list[DataFrame], DataFrame]:
    """The levels of trees, and their tops.

    ``nodes``: tree, size (nodes of the tree on this level), pos, digest, row. ``last(tree)`` names the node that a tree's top
    is one step further up. A level: a row for each node below it: ``node``, ``up`` (where it points), ``segment`` and ``row``.
    """
    levels, tops, tree, row = [], [], nodes, nodes.schema["row"].dataType
    for level in range(height):
        tops.append(tree.where("size = 1").select("tree", "digest", F.lit(level).alias("level")))
        member = F.sort_array(F.collect_list(F.struct("pos", "digest", "row")))
        runs = (tree.where("size > 1").groupBy("tree", "size", F.expr(f"pos div {fanout}").alias("run")).agg(member.alias("m"))
                .select("tree", F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"), F.col("run").alias("pos"), F.col("m.digest").alias("members"), F.col("m.row").alias("rows")))
        runs = staged(runs, "runs")
        up = F.when(F.col("size") == 1, last(F.col("tree"))).otherwise(_node(F.col("tree"), level + 1, F.col("pos")))
        below = runs.select("tree", "members", up.alias("up"), F.col("pos").alias("run"), F.posexplode("rows").alias("k", "row"))
        left, right = F.slice("members", F.lit(1), F.col("k")), F.slice("members", F.col("k") + 2, F.lit(fanout))
        segment = F.array(F.struct(_joined(left).alias("l"), _joined(right).alias("r"))).cast(_SEGMENT)
        levels.append(below.select(_node(F.col("tree"), level, F.col("run") * fanout + F.col("k")).alias("node"), "up", segment.alias("segment"), "row"))
        tree = runs.select("tree", "size", "pos", F.unhex(F.sha2(_hex(_joined(F.col("members"))), 256)).alias("digest"), F.lit(None).cast(row).alias("row"))
    tops.append(tree.where("size = 1").select("tree", "digest", F.lit(height).alias("level")))
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return levels, out


def _folded(leaf: Column, segment: Column) -> Column:
    """The root that a leaf (hex) and its siblings give."""
    return F.aggregate(segment, leaf, lambda a, s: F.sha2(F.concat(_hex(s["l"]), a, _hex(s["r"])), 256))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", by: str = "lang", fanout: int = 8,
             tampered: dict[str, Column] | None = None, tampers: Column | None = None) -> DataFrame:
    """One row for each of ``docs``: the id, ``leaf``, ``subroot``, ``root``, the ``segment`` of its siblings (an array, from
    the leaf to the root, of the digests left and right of the path), ``proof_sha256`` (of these digests in order),
    ``folded_root`` and ``verified``.

    ``tampered`` names columns and what replaces them where ``tampers`` holds, after the tree was made: the fold starts from
    the leaf of the changed row. Jobs run when it is called.
    """
    field = {f: F.col(f"`{f}`") for f in fields}
    leaf = leaf_digest(list(field.values()))
    forged = F.when(F.coalesce(tampers, F.lit(False)), leaf_digest([(tampered or {}).get(f, c) for f, c in field.items()])) if tampers is not None else F.lit(None).cast("string")
    leaves = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{by}`").cast("string").alias("value"), F.unhex(leaf).alias("digest"), F.unhex(forged).alias("forged"))
    placed = _placed(leaves, "value", ["id", "digest"])
    values = staged(_placed(placed.where("pos = 0").select("value", F.lit(0).alias("all"), F.col("size").alias("leaves")), "all", ["value"])
                    .select(F.col("value").alias("_value"), F.col("pos").alias("tree"), "leaves", F.col("size").alias("values")), "values")
    largest, trees = values.agg(F.max("leaves"), F.max("values")).first()
    placed = placed.join(F.broadcast(values) if (trees or 0) <= SMALL_NODES else values, F.col("value").eqNullSafe(F.col("_value")))
    placed = staged(placed.select("tree", "size", "pos", "digest", F.struct("id", "tree", "digest", "forged").alias("row")), "leaves")

    heights = _height(largest or 0, fanout), _height(trees or 0, fanout)
    nowhere = F.lit(None).cast("struct<tree: bigint, level: int, pos: bigint>")
    levels, tops = _tree(placed, heights[0], fanout, lambda tree: _node(F.lit(-1), 0, tree))
    tops = staged(tops, "subroots")
    subroots = tops.select(F.lit(-1).cast("long").alias("tree"), F.lit(trees or 0).cast("long").alias("size"), F.col("tree").alias("pos"), "digest",
                           F.lit(None).cast(placed.schema["row"].dataType).alias("row"))
    high, root = _tree(subroots, heights[1], fanout, lambda tree: nowhere)
    root = root.first()

    # The leaf of a partition of one row is its subroot: it points into the tree of subroots at once.
    nodes = placed.where("size = 1").select(_node(F.col("tree"), 0, F.col("pos")).alias("node"), _node(F.lit(-1), 0, F.col("tree")).alias("up"),
                                            F.array().cast(_SEGMENT).alias("segment"), "row")
    for part in [*levels, *high]:
        nodes = nodes.unionByName(part)
    distance, height = 1, sum(heights) + (0 if heights[0] else 1)
    while distance < height:
        nodes = staged(nodes, f"nodes-{distance}")
        # Pointers lead at least ``distance`` levels up, or into the tree of subroots: only such nodes are looked up.
        above = nodes.where((F.col("node.level") >= distance) | (F.col("node.tree") == -1)).select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("segment").alias("_segment"))
        reach = (largest // fanout ** distance + 2) * trees + trees
        joined = nodes.join(F.broadcast(above) if reach <= SMALL_NODES // 8 else above, F.col("up") == F.col("_node"), "left")
        nodes = joined.select("node", F.col("_up").alias("up"), F.concat("segment", F.coalesce("_segment", F.array().cast(_SEGMENT))).alias("segment"), "row")
        distance *= 2

    leaves = nodes.where("row is not null").select("row.*", "segment")
    subroot = tops.select(F.col("tree").alias("_tree"), _hex(F.col("digest")).alias("subroot"))
    out = leaves.join(F.broadcast(subroot) if (trees or 0) <= SMALL_NODES else subroot, F.col("tree") == F.col("_tree"))
    whole = F.aggregate("segment", F.lit(b""), lambda a, s: F.concat(a, s["l"], s["r"]))
    out = out.select(F.col("id").alias(id_col), _hex(F.col("digest")).alias("leaf"), "subroot", F.lit(root.digest.hex() if root else None).cast("string").alias("root"),
                     "segment", F.sha2(_hex(whole), 256).alias("proof_sha256"),
                     _folded(_hex(F.coalesce("forged", "digest")), F.col("segment")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_case(column: Column) -> Column:
    """A-Z of a text as a-z."""
    return F.translate(column, _UPPER, _LOWER)
