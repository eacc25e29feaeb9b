"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import bind, id_text
from asterism.operators.events import with_surrogate_id

#: Hex digits of a digest used for one draw: 52 bits fit a double exactly.
DRAW_DIGITS = 13
#: Shards of a rack and racks of a region.
RACK_SHARDS, REGION_RACKS = 4, 2

#: Regions, each a list of racks, each a list of (shard, weight).
Tree = list[list[list[tuple[int, float]]]]


def layout(shards: int) -> Tree:
    """Whole regions of equal shards; each shard that is left over is a region of its own."""
    size = RACK_SHARDS * REGION_RACKS
    whole = shards // size * size
    tree: Tree = [[[(s, 1.0) for s in range(k, k + RACK_SHARDS)] for k in range(r, r + size, RACK_SHARDS)]
                  for r in range(0, whole, size)]
    for s in range(whole, shards):
        tree = grow(tree, s)
    return tree


def grow(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """``tree`` with a new shard as a region of its own: no other weight changes, so
    keys move into it and nowhere else."""
    return [*tree, [[(shard, weight)]]]


def choose(key: Column, tree: Tree) -> Column:
    """The shard of ``key`` (a string): from the root down, the child with the smallest weighted draw.

    A draw is ``-ln(u) / weight``, u uniform in (0, 1] from the MD5 digest of key and
    node path. The child with the least wins, which happens in proportion to its
    weight; a node whose weight changes gains or loses keys only for itself.
    The tree is metadata (one entry a node), so it is part of the expression.
    """
    total = lambda xs: sum(total(x) if isinstance(x, list) else x[1] for x in xs)
    levels: list[dict[str, list[float]]] = [{"": [total(region) for region in tree]}, {}, {}]
    leaves: dict[str, int] = {}
    for r, region in enumerate(tree):
        levels[1][f"/{r}"] = [total(rack) for rack in region]
        for k, rack in enumerate(region):
            levels[2][f"/{r}/{k}"] = [w for _, w in rack]
            leaves |= {f"/{r}/{k}/{i}": s for i, (s, _) in enumerate(rack)}

    def literal(entries: dict) -> Column:
        return F.create_map(*[x for k, v in entries.items() for x in (
            F.lit(k), F.array(*[F.lit(w) for w in v]) if isinstance(v, list) else F.lit(v))])

    def descend(path: Column, level: int) -> Column:
        def draw(weight: Column, i: Column) -> Column:
            digits = F.substring(F.md5(F.concat(key, path, F.lit("/"), i.cast("string"))), 1, DRAW_DIGITS)
            u = (F.conv(digits, 16, 10).cast("double") + 1) / float(16 ** DRAW_DIGITS)
            return F.struct((-F.ln(u) / weight).alias("draw"), i.alias("child"))

        child = F.array_min(F.transform(F.element_at(literal(levels[level]), path), draw))["child"]
        return bind(F.concat(path, F.lit("/"), child.cast("string")),
                    (lambda p: descend(p, level + 1)) if level < 2 else lambda p: F.element_at(literal(leaves), p))

    return descend(F.lit(""), 0).cast("int")


def shard_documents(docs: DataFrame, tree: Tree, grown_tree: Tree | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its shard and a gapless slot there, in order of doc_id.

    ``doc_id, size, text_crc32, shard, slot`` and, with ``grown_tree``, ``grown_shard``.
    The id and the tree alone decide the shard, so rows never wait for each other.
    Slots are positions in the global (shard, doc_id) order less the rows of lower
    shards; that order is laid out by range, so a shard spans many tasks.

    Defined cases: null text has no bytes (size 8, CRC of nothing); a null id hashes
    like an empty string; rows that repeat an id share a shard and take a slot each;
    an empty table gives an empty result; other columns are ignored.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = id_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length("text") + 8).cast("long").alias("size"), F.crc32("text").alias("text_crc32"),
        choose(key, tree).alias("shard"),
        (choose(key, grown_tree) if grown_tree else F.lit(None).cast("int")).alias("grown_shard"))
    placed = with_surrogate_id(rows, "position", ["shard", "doc_id"])
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))  # a row a shard
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot"),
                    "grown_shard"))
