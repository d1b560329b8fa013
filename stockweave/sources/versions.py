"""Numbered versions, claimed optimistically, and keyed tables that are rewritten by bucket.

Plain Parquet has neither MERGE nor overwrite-while-reading. Data goes to folders of its
own first; a version is then claimed by renaming a small file to the version's number, which fails where the
number is taken. Of two publishers at once one takes the next number, none is lost, and a
publisher that dies leaves no version behind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def latest(spark: SparkSession, root: str) -> int:
    """Number of the last version, 0 when there is none."""
    hadoop, files = _file_system(spark, root)
    folder = hadoop.Path(f"{root}/versions")
    if not files.exists(folder):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def content(spark: SparkSession, root: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{root}/versions/{version:012}").first()["value"])


def claim(spark: SparkSession, root: str, version: int, what: dict) -> bool:
    """Make `what` the content of a version, unless somebody else has claimed its number."""
    hadoop, files = _file_system(spark, root)
    target, draft = hadoop.Path(f"{root}/versions/{version:012}"), hadoop.Path(f"{root}/versions/_{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(what).encode()))
    out.close()
    once = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(once, 1)
    options[0] = once.NONE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, options)
    except Exception as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" not in str(error):
            raise
        return False
    return True


def publish_next(spark: SparkSession, root: str, what: dict) -> int:
    """Claim the next free version for `what`."""
    version = latest(spark, root) + 1
    while not claim(spark, root, version, what):
        version = max(version, latest(spark, root)) + 1
    return version


@dataclass(frozen=True)
class Entry:
    """One bucket of one table: where it lies, its rows and an order-free checksum over them."""

    folder: str
    rows: int
    digest: int


_MANIFEST = "name string, bucket int, folder string, rows long, digest decimal(38,0)"


def _checksum(columns: list[str]) -> Column:
    return F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).cast("decimal(38,0)")


class KeyedStore:
    """Tables with unique keys under one root, cut into buckets by the hash of the key.

    A version is a manifest of bucket folders over all tables, so it changes all of them or none. A change
    rewrites the buckets that hold its keys; the other buckets keep their files. Manifests have
    `buckets` rows a table at most, the only thing the driver holds. Choose `buckets` so that one
    fits a task. Keys must be unique; tables must have no map columns.
    """

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, tuple[str, ...]], buckets: int = 64) -> None:
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets

    def bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*self.keys[name]), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        return latest(self.spark, self.root)

    def _content(self, version: int | None) -> dict:
        version = self.version() if version is None else version
        if not version:
            raise FileNotFoundError(f"nothing published under {self.root}")
        return content(self.spark, self.root, version)

    def entries(self, version: int | None = None) -> dict[tuple[str, int], Entry]:
        return self._entries(self._content(version))

    def _entries(self, what: dict) -> dict[tuple[str, int], Entry]:
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifests/{what['manifest']}").collect()
        return {(r["name"], r["bucket"]): Entry(r["folder"], r["rows"], int(r["digest"])) for r in rows}

    def schema(self, name: str, version: int | None = None) -> StructType:
        return StructType.fromJson(self._content(version)["schemas"][name])

    def read(self, name: str, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or some buckets of it."""
        what = self._content(version)
        return self._read(name, what, self._entries(what), buckets)

    def _read(self, name: str, what: dict, entries: dict, buckets: Iterable[int] | None) -> DataFrame:
        schema = StructType.fromJson(what["schemas"][name])
        wanted = None if buckets is None else set(buckets)
        paths = [
            f"{self.root}/data/{e.folder}/{n}/_bucket={b}" for (n, b), e in sorted(entries.items()) if n == name and (wanted is None or b in wanted)
        ]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, name: str, rows: DataFrame, folder: str) -> dict[tuple[str, int], Entry]:
        path = f"{self.root}/data/{folder}/{name}"
        placed = rows.withColumn("_bucket", self.bucket(name)).repartition("_bucket")
        placed.write.partitionBy("_bucket").parquet(path)
        found = self.digests(name, self.spark.read.schema(placed.schema).parquet(path), rows.columns)
        return {(name, r["_bucket"]): Entry(folder, r["rows"], int(r["digest"])) for r in found.collect()}

    def digests(self, name: str, rows: DataFrame, columns: list[str]) -> DataFrame:
        """_bucket, rows and digest of `rows`: one pass, combined before the shuffle, a row per bucket."""
        bucket = F.col("_bucket") if "_bucket" in rows.columns else self.bucket(name).alias("_bucket")
        return rows.select(bucket, *columns).groupBy("_bucket").agg(F.count("*").alias("rows"), _checksum(columns).alias("digest"))

    def _manifest(self, entries: dict[tuple[str, int], Entry]) -> str:
        folder = uuid.uuid4().hex
        rows = [(n, b, e.folder, e.rows, e.digest) for (n, b), e in entries.items()]
        listed = self.spark.createDataFrame([(n, b, f, r, str(d)) for n, b, f, r, d in rows], "name string, bucket int, folder string, rows long, digest string")
        listed = listed.withColumn("digest", F.col("digest").cast("decimal(38,0)"))
        listed.coalesce(1).write.parquet(f"{self.root}/manifests/{folder}")
        return folder

    def create(self, tables: dict[str, DataFrame]) -> int:
        """The first version, or one that replaces all tables."""
        folder, entries = uuid.uuid4().hex, {}
        for name, rows in tables.items():
            entries |= self._write(name, rows, folder)
        schemas = {name: rows.schema.jsonValue() for name, rows in tables.items()}
        return publish_next(self.spark, self.root, {"manifest": self._manifest(entries), "schemas": schemas})

    def touched(self, keys: dict[str, DataFrame]) -> dict[str, set[int]]:
        """The buckets of the given keys, per table."""
        return {
            name: {r["b"] for r in rows.select(self.bucket(name).alias("b")).distinct().collect()}  # `buckets` rows at most
            for name, rows in keys.items()
        }

    def change(self, keys: dict[str, DataFrame], apply: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]) -> int:
        """Replace the buckets of `keys` (rows with the key columns, per table) by what `apply` makes of them.

        `apply` gets the rows of these buckets and returns them as they shall be. Where another
        version was claimed meanwhile, the change is put on top of it; it is computed again only if that version
        touched one of the same buckets.
        """
        touched = self.touched(keys)
        while True:
            base = self.version()
            what = self._content(base)
            entries = self._entries(what)
            old = {name: self._read(name, what, entries, buckets) for name, buckets in touched.items()}
            folder, written = uuid.uuid4().hex, {}
            for name, rows in apply(old).items():
                written |= self._write(name, rows.select(*old[name].columns), folder)
            strays = {(n, b) for n, b in written if b not in touched[n]}
            if strays:
                raise ValueError(f"rows outside the changed buckets: {sorted(strays)[:5]}")
            mine = {(n, b) for n, buckets in touched.items() for b in buckets}
            while True:
                now = self.version()
                what = self._content(now)
                current = self._entries(what)
                if any(current.get(k) != entries.get(k) for k in mine):
                    break
                merged = {k: e for k, e in current.items() if k not in mine} | written
                if claim(self.spark, self.root, now + 1, what | {"manifest": self._manifest(merged)}):
                    return now + 1

    def stale_buckets(self, name: str, new: DataFrame, version: int | None = None) -> set[int]:
        """Buckets in which `new` differs from the stored table, by row count and checksum."""
        what = self._content(version)
        stored = {b: (e.rows, e.digest) for (n, b), e in self._entries(what).items() if n == name}
        columns = StructType.fromJson(what["schemas"][name]).fieldNames()
        fresh = {r["_bucket"]: (r["rows"], int(r["digest"])) for r in self.digests(name, new, columns).collect()}
        return {b for b in stored.keys() | fresh.keys() if stored.get(b) != fresh.get(b)}
