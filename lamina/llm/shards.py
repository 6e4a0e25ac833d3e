"""Shards by a hierarchical weighted hash tree.

A row goes down from regions through racks to shards.  At each level every
child draws an exponential variate by a hash of the key and the child's name,
divided by the weight of the child's subtree; the smallest draw wins, so that a
child is chosen in proportion to its weight.  Only the children of the subtree
that was chosen draw again: a row takes as many hashes as regions, racks of a
region and shards of a rack, not as many as there are shards.  A change of
weights changes only the draws of the subtrees that hold it, so rows move into
or out of these or within them; between two others nothing ever moves.

A shard that is added stands as a region of its own.  All other subtrees keep
their weights, so it takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.shared import stage

RACK, REGION = 5, 4  # shards in a rack, racks in a region
#: A tree: regions of racks of (shard, weight).
Tree = list[list[list[tuple[int, float]]]]


def tree_of(weights: list[float], added: int = 0) -> Tree:
    """Regions of racks of shards, numbered along; the last ``added`` shards are regions of their own."""
    n = len(weights) - added
    shards = list(enumerate(map(float, weights)))
    racks = [shards[i : min(i + RACK, n)] for i in range(0, n, RACK)]
    return [racks[i : i + REGION] for i in range(0, len(racks), REGION)] + [[[x]] for x in shards[n:]]


def chosen(key: F.Column, level: str, parent: F.Column, weights: F.Column, children: int) -> F.Column:
    """The number of the child with the smallest draw: ``weights`` is an array of the children's, 0 or null for none."""

    def draw(child: int) -> F.Column:
        # 53 bits of a hash; the draw of a child with weight w has rate w.
        uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(level), parent, F.lit(child)), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        weight = F.get(weights, F.lit(child))
        return F.when(weight > 0, F.struct((-F.log(uniform) / weight).alias("draw"), F.lit(child).alias("child")))

    return F.array_min(F.array(*[draw(c) for c in range(children)]))["child"]


def placed(df: DataFrame, key: str, tree: Tree, name: str) -> DataFrame:
    """Adds the shard ``name`` of each row.  Shards, racks and regions without weight get no rows."""
    weights = [[[w for _, w in rack] for rack in region] for region in tree]
    if not sum(w for region in weights for rack in region for w in rack) > 0:
        raise ValueError("no shard has a weight")
    col, own = F.col(f"`{key}`"), {x: f"_{name}_{x}" for x in ("region", "rack", "place")}
    region, rack, place = (F.col(f"`{own[x]}`") for x in own)
    doubles = lambda xs: F.array(*[F.lit(float(x)) for x in xs]) if xs else F.array().cast("array<double>")
    at = lambda table, i: F.get(F.array(*table), i)
    out = df.withColumn(own["region"], chosen(col, "region", F.lit(0), doubles([sum(map(sum, r)) for r in weights]), len(tree)))
    out = out.withColumn(own["rack"], chosen(col, "rack", region, at([doubles([sum(k) for k in r]) for r in weights], region), max(map(len, tree))))
    out = out.withColumn(own["place"], chosen(col, "shard", F.struct(region, rack), at([F.array(*map(doubles, r)) for r in weights], region)[rack], max(len(k) for r in tree for k in r)))
    numbers = [F.array(*[F.array(*[F.lit(s) for s, _ in k]) for k in r]) for r in tree]
    return out.withColumn(name, at(numbers, region)[rack][place]).drop(*own.values())


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    The law is ``key``.  Null text has no bytes (crc32 0); null doc_ids share
    one shard, as one doc_id's rows do.  Slots count up from 0 within a shard,
    by input task and then by doc_id, size and crc32.  ``grown_shard`` is the
    shard with one more, which the tree takes as a region of its own.  Repeated
    rows count as rows; an empty table gives none.

    Nothing but these few numbers of a row is shuffled.  A shard's rows are
    numbered within each input task, so that no task holds a whole shard, and
    the offsets come from one count for each shard and task.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(16)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    own = placed(placed(rows, "doc_id", tree_of([1.0] * shards), "shard"), "doc_id", tree_of([1.0] * (shards + 1), added=1), "grown_shard")
    own = stage(own.withColumn("task", F.spark_partition_id()), "shards")
    within = F.row_number().over(Window.partitionBy("task", "shard").orderBy("doc_id", "size", "text_crc32")) - 1
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = own.groupBy("shard", "task").agg(F.count("*").alias("n")).select("shard", "task", F.coalesce(before, F.lit(0)).alias("offset"))
    out = own.withColumn("local", within).join(offsets, ["shard", "task"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("local") + F.col("offset")).cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))
