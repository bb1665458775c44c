"""Fixity audit of web archive replicas by Merkle trees over offset ranges.

A record is known by its archive and offset. Its hash is a leaf; leaves whose
offsets lie in the same range of RANGE_BYTES hang under one node, and FAN
successive nodes under one of the next level, up to a root per archive, each
node hashing its children in order. Roots of two replicas are compared first;
then, level by level, only children of nodes that differ, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbsight.sources.storage import materialize

RANGE_BYTES = 1 << 16
FAN = 16
PAGES_PER_ARCHIVE = 4096


def warc_records(pages: DataFrame, per_archive: int = PAGES_PER_ARCHIVE) -> DataFrame:
    """``pages`` as archived responses: ``archive``, ``offset``, ``page_id``, ``record`` (binary).

    Archives take pages by number, ``per_archive`` ids each, in order of id,
    then url and content; pages without an id have an archive of their own per
    first two digits of the content's hash, so it doesn't gather all of them.
    Null urls and contents count as empty.
    """
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.concat(head, html, F.lit("\r\n\r\n")).cast("binary").alias("record"))
    nameless = F.concat(F.lit("none-"), F.substring(F.sha2("record", 256), 1, 2))
    rows = rows.withColumn("archive", F.coalesce(F.floor(F.col("page_id") / per_archive).cast("string"), nameless))
    before = Window.partitionBy("archive").orderBy("page_id", "record").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.octet_length("record")).over(before), F.lit(0)).cast("long")
    return rows.select("archive", offset.alias("offset"), "page_id", "record")


def leaves(records: DataFrame) -> DataFrame:
    """``archive``, ``offset``, ``length`` and ``hash`` of each record; a null record has the hash of nothing.

    Records that share an archive and offset are one leaf, hashed in order.
    """
    one = records.select("archive", "offset", F.octet_length("record").alias("length"), F.sha2(F.coalesce("record", F.lit(b"")), 256).alias("hash"))
    together = one.groupBy("archive", "offset").agg(F.max("length").cast("long").alias("length"), F.array_sort(F.collect_list("hash")).alias("all"))
    alone = F.get("all", F.lit(0))
    return together.select("archive", "offset", "length", F.when(F.size("all") == 1, alone).otherwise(F.sha2(F.array_join("all", ""), 256)).alias("hash"))


def tree(leaf: DataFrame, levels: int) -> DataFrame:
    """All inner nodes: ``archive``, ``level``, ``node``, ``hash``; level 1 is over records, ``levels`` is the root's."""
    hashes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda c: F.concat(c["at"].cast("string"), F.lit(":"), c["hash"])), ",")
    below = leaf.select("archive", F.floor(F.col("offset") / RANGE_BYTES).alias("node"), F.col("offset").alias("at"), "hash")
    nodes = None
    for level in range(1, levels + 1):
        grown = materialize(below.groupBy("archive", "node").agg(F.sha2(hashes, 256).alias("hash")), "nodes")
        own = grown.select("archive", F.lit(level).alias("level"), "node", "hash")
        nodes = own if nodes is None else nodes.unionByName(own)
        # The root's level takes in whatever is left.
        up = F.floor(F.col("node") / FAN) if level + 1 < levels else F.lit(0).cast("long")
        below = grown.select("archive", up.alias("node"), F.col("node").alias("at"), "hash")
    return nodes


def height(*leaf_tables: DataFrame) -> int:
    """Levels so that no root has more than FAN children, at least two."""
    top = max(df.agg(F.max("offset")).first()[0] or 0 for df in leaf_tables)
    ranges, levels = top // RANGE_BYTES + 1, 1
    while ranges > 1:
        ranges, levels = -(-ranges // FAN), levels + 1
    return max(levels, 2)


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records in which two replicas differ: ``archive``, ``offset``, ``status``, ``left_length``, ``right_length``, ``left_hash``, ``right_hash``.

    Both tables hold ``archive``, ``offset`` and ``record``. Status is
    ``changed``, or ``left only`` or ``right only`` where the other replica has
    nothing at that offset; whole archives may be missing. Records of one
    archive and offset count as one. Equal replicas, empty ones among them,
    give no rows. A null archive or offset names no place: such records are
    left out. Extra columns play no part; long records are hashed whole.
    """
    places = "archive IS NOT NULL AND offset IS NOT NULL"
    leaf = {side: materialize(leaves(df.where(places)), f"{side}-leaves") for side, df in (("left", left), ("right", right))}
    levels = height(*leaf.values())
    nodes = {side: tree(df, levels) for side, df in leaf.items()}
    suspects = None
    for level in range(levels, 0, -1):
        sides = {side: df.where(F.col("level") == level).select("archive", "node", F.col("hash").alias(side)) for side, df in nodes.items()}
        if suspects is not None:
            parent = F.floor(F.col("node") / FAN) if level + 1 < levels else F.lit(0).cast("long")
            sides = {side: df.withColumn("parent", parent).join(suspects, ["archive", "parent"], "left_semi").drop("parent") for side, df in sides.items()}
        differing = _different(sides["left"], sides["right"], ["archive", "node"])
        suspects = materialize(differing.select("archive", F.col("node").alias("parent")), "suspects")
    ranged = {
        side: df.withColumn("parent", F.floor(F.col("offset") / RANGE_BYTES)).join(suspects, ["archive", "parent"], "left_semi")
        .select("archive", "offset", F.col("length").alias(f"{side}_length"), F.col("hash").alias(side))
        for side, df in leaf.items()
    }
    status = F.when(F.col("right").isNull(), "left only").when(F.col("left").isNull(), "right only").otherwise("changed")
    return _different(ranged["left"], ranged["right"], ["archive", "offset"]).select(
        "archive", "offset", status.alias("status"), "left_length", "right_length", F.col("left").alias("left_hash"), F.col("right").alias("right_hash")
    )


def _different(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "full").where(~_same())


def _same() -> Column:
    return F.col("left").eqNullSafe(F.col("right"))
