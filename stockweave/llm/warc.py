"""WARC fixity: a Merkle audit of replicas.

A record's leaf is the hash of its offset, length and content digest. Leaves are
hashed, in order of offset, into ranges of 64 KiB of the file, sixteen of these
into a range of 1 MiB, and so on to one node per file; sixteen files by number make
a node, up to one root for the collection. A node sits at fixed offsets, so one
damaged or missing record changes only the nodes above it.

Two replicas are compared from the root: equal roots end the audit. Otherwise the
children of differing nodes, and only those, are compared level by level, down to the
records. Every level is one small aggregate whose groups hold sixteen children, or the
records that start in 64 KiB, and is written once; contents are read once, for
their digests.

`lay_out` places records of pages in files as a crawler would write them. Null urls and
html count as empty; rows without page_id come first, repeated rows are records of
their own, and an empty table has no records and no differences.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.operators.ranking import rank_rows
from stockweave.session import settle_table

FILE_RECORDS = 1_000
LEAF_BITS = 16  # 64 KiB
FAN_BITS = 4


def record(url: Column, html: Column) -> Column:
    """The bytes of a response record."""
    body = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), body, F.lit(b"\r\n\r\n"))


def lay_out(records: DataFrame, order: list[str], file_records: int = FILE_RECORDS) -> DataFrame:
    """`records` (with length) with file and offset: in order, so many to a file, one after the other."""
    ranked = rank_rows(records, [F.col(c).asc_nulls_first() for c in order])
    placed = ranked.withColumn("file", F.floor((F.col("position") - 1) / file_records))
    before = Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("position")


@dataclass(frozen=True)
class Shape:
    """Levels of ranges within a file, and of groups of files above them."""

    ranges: int
    files: int

    @classmethod
    def of(cls, *replicas: DataFrame) -> Shape:
        """As many levels as the largest offset and file number of the replicas need."""
        ends = [r.agg(F.max("offset"), F.max("file")).first() for r in replicas]
        offset, file = (max((e[i] or 0) for e in ends) for i in range(2))
        ranges, files = 1, 1
        while offset >> (LEAF_BITS + FAN_BITS * (ranges - 1)):
            ranges += 1
        while file >> (FAN_BITS * files):
            files += 1
        return cls(ranges, files)

    @property
    def levels(self) -> int:
        return self.ranges + self.files

    def node(self, level: int) -> list[Column]:
        """The node of a row (file, offset) at a level."""
        if level <= self.ranges:
            at = F.shiftright("offset", LEAF_BITS + FAN_BITS * (level - 1))
            return [F.col("file").alias("file"), at.alias("at")]
        return [F.shiftright("file", FAN_BITS * (level - self.ranges)).alias("file"), F.lit(0).cast("long").alias("at")]

    def parent(self, level: int) -> list[Column]:
        """The node above a row of `level`."""
        if level == 0:
            return self.node(1)
        if level < self.ranges:
            return [F.col("file").alias("file"), F.shiftright("at", FAN_BITS).alias("at")]
        return [F.shiftright("file", FAN_BITS).alias("file"), F.lit(0).cast("long").alias("at")]


def tree(leaves: DataFrame, shape: Shape) -> list[DataFrame]:
    """Level 0 (file, offset, length, hash) and above it (file, at, hash) up to the root."""
    own = F.sha2(F.concat_ws(":", "offset", "length", "digest"), 256)
    found = [settle_table(leaves.select("file", "offset", "length", own.alias("hash")), "warc-leaves")]
    children = found[0].select("file", "offset", "hash")
    for level in range(1, shape.levels + 1):
        child = F.struct("file", "offset", "hash").alias("child")
        nodes = children.select(*shape.node(level), child).groupBy("file", "at")
        nodes = nodes.agg(F.array_sort(F.collect_list("child")).alias("children"))
        joined = F.transform("children", lambda c: F.concat_ws(":", c["file"], c["offset"], c["hash"]))
        found.append(settle_table(nodes.select("file", "at", F.sha2(F.array_join(joined, ","), 256).alias("hash")), "warc-nodes"))
        # a node stands where its range starts, not where its first record does
        low = level <= shape.ranges
        start = F.shiftleft("at", LEAF_BITS + FAN_BITS * (level - 1)) if low else F.lit(0).cast("long")
        width = 0 if low else FAN_BITS * (level - shape.ranges)
        children = found[-1].select(F.shiftleft("file", width).alias("file"), start.alias("offset"), "hash")
    return found


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records that differ: file, offset, length, replica_length and fault (changed, missing or extra).

    Both inputs have file, offset (unique within the file), length and digest.
    """
    shape = Shape.of(primary, replica)
    one, two = tree(primary, shape), tree(replica, shape)
    suspects = None
    for level in range(shape.levels, -1, -1):
        key = ["file", "at"] if level else ["file", "offset"]

        def side(table: DataFrame, name: str) -> DataFrame:
            length = [] if level else [F.col("length").alias(f"{name}_length")]
            rows = table.select(*key, F.col("hash").alias(name), *length)
            if suspects is None:
                return rows
            up = shape.parent(level)
            # few branches differ; the planner broadcasts them if they are small
            above = suspects.select(F.col("file").alias("_file"), F.col("at").alias("_at"))
            return rows.withColumns({"_file": up[0], "_at": up[1]}).join(above, ["_file", "_at"], "left_semi").drop("_file", "_at")

        both = side(one[level], "a").join(side(two[level], "b"), key, "full_outer")
        differ = both.filter(~F.col("a").eqNullSafe(F.col("b")))
        if level:
            suspects = settle_table(differ.select(*key), "warc-suspects")
            if suspects.isEmpty():
                break
    fault = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    if level:  # equal roots
        empty = "file long, offset long, length long, replica_length long, fault string"
        return primary.sparkSession.createDataFrame([], empty)
    return differ.select(
        "file", "offset", F.col("a_length").alias("length"), F.col("b_length").alias("replica_length"), fault.alias("fault")
    )
