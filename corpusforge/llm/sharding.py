"""Hierarchical weighted hash tree: rows descend region, rack and shard by weighted hash draws.

At each level every child draws a number for the row, -ln(u) / weight, from a hash of the row's
key and the child's name; the smallest wins. A child's draw depends on nothing but the key, its
own name and its own weight, so a change of weight moves rows only into or out of that subtree,
and a region that is added takes rows only into itself. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, narrow

#: Slots are numbered over this many parts of a shard, so that a shard of any size is not one task.
PARTS = 1024


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = 2, racks: int = 2) -> list[Leaf]:
    """Shards 0..n-1: as many whole regions as there are powers of the first layout, and each later shard in a region of its own.

    The first layout has two regions of `racks` racks of `per_rack` shards (if n has room for it); every shard after
    it opens a region, so that one more shard takes rows only into itself.
    """
    first = 2 * racks * per_rack
    regular = first if shards >= first else 0
    leaves = [Leaf(f"region{i // (racks * per_rack)}", f"rack{i // per_rack}", i) for i in range(regular)]
    return leaves + [Leaf(f"own{i}", f"own{i}", i) for i in range(regular, shards)]


def _draw(key: Column, name: str, weight: float) -> Column:
    """-ln(u) / weight, u in (0, 1) from 52 bits of a hash of the child's name and the key."""
    digest = F.md5(F.concat(F.lit(f"{name}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / F.lit(float(weight))


def _choose(key: Column, children: dict[str, float]) -> Column:
    """The name of the child with the smallest draw; equal draws go to the smaller name."""
    if len(children) == 1:
        return F.lit(next(iter(children)))
    return F.least(*(F.struct(_draw(key, name, weight).alias("draw"), F.lit(name).alias("name")) for name, weight in children.items() if weight > 0))["name"]


def descend(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key."""
    def weights(rows: list[Leaf], name) -> dict[str, float]:
        out: dict[str, float] = {}
        for leaf in rows:
            out[name(leaf)] = out.get(name(leaf), 0.0) + leaf.weight
        return {k: v for k, v in out.items() if v > 0}

    def pick(chosen: Column, options: dict[str, Column]) -> Column:
        if len(options) == 1:
            return next(iter(options.values()))
        out = None
        for name, column in options.items():
            out = F.when(chosen == name, column) if out is None else out.when(chosen == name, column)
        return out

    def level(rows: list[Leaf], names: list) -> Column:
        name, rest = names[0], names[1:]
        children = weights(rows, name)
        chosen = _choose(key, children)
        if not rest:
            return chosen
        return pick(chosen, {c: level([x for x in rows if name(x) == c], rest) for c in children})

    path = [lambda x: x.region, lambda x: f"{x.region}/{x.rack}", lambda x: f"{x.region}/{x.rack}/{x.shard}"]
    return F.element_at(F.split(level(leaves, path), "/"), -1).cast("int")


def shard(rows: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Places every row by its id alone (law `key`) and numbers the rows of each shard without gaps.

    Returns id, size (UTF-8 bytes of the text plus 1; a null text has none), text_crc32 (null: of no bytes), law, shard,
    slot, grown_shard (under the layout `grown`, else null). A null id is a key like any other. Repeated rows share a
    shard and get a slot each. Very long texts only count by size and check sum. An empty table gives an empty result; other columns are
    ignored. Slots are numbered over parts by id and check sum, so that many rows without id, or of one id, are many parts.
    """
    content = F.coalesce("text", F.lit(""))
    placed = narrow(rows, id=id, text=text).select(
        "id",
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        descend(F.col("id"), leaves).alias("shard"),
    )
    placed = checkpoint(placed.withColumn("part", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(PARTS)).cast("int")))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    # At most PARTS rows per shard.
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size")
    return (
        placed.withColumn("nth", F.row_number().over(within) - 1)
        .join(starts, ["shard", "part"])
        .select(
            F.col("id").alias(id), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("nth")).cast("long").alias("slot"),
            (descend(F.col("id"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        )
    )
