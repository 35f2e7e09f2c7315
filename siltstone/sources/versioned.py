"""A keyed table that grows by deltas, is read as of a version, and is compacted without a reader noticing.

``data/`` holds folders of Parquet files, bucketed by a hash of the keys: deltas of rows that came in or were deleted (tombstones), and
bases, which stand for all deltas before them. ``manifests/`` holds one small file a version, which lists the folders that make it up. A
version is there when its manifest has its name, which a rename gives it only if the name is free; so writers that meet take turns: who
comes second adds its folder to the other's list and tries the next name. What no manifest lists does not exist, so a writer
may die at any point. An upsert writes its own rows and nothing else.

Readers take one manifest and see its version, whatever is written or compacted meanwhile; ``vacuum`` removes folders and manifests that
only versions older than the last few needed.

Defined cases: rows of equal key and order: the one that came in last stays, and within one delta the greatest by its other columns;
null keys are keys like others; an empty delta makes a version; a table without a version is empty and has no schema, so
reading it raises; a tag that a version lists already is not written again (a stream's batch that is run twice).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16


class Conflict(Exception):
    """The name of a version was taken by another writer."""


class VersionedLog:
    """A table of rows with keys, of which the greatest by order counts."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: str, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path.rstrip("/"), keys, order, buckets
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        """All versions that can be read, in order."""
        at = self._at("manifests")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        """{version, schema, folders: [{folder, kind, tag}]} of a version, else of the last one."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "schema": None, "folders": []}
        stream = self._fs.open(self._at(f"manifests/{(version if version is not None else known[-1]):010d}.json"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _commit(self, made: dict) -> None:
        """Give a manifest its name; Conflict if it is taken."""
        hidden = f"manifests/.{uuid.uuid4().hex}.tmp"
        out = self._fs.create(self._at(hidden))
        out.write(bytearray(json.dumps(made).encode()))
        out.close()
        self._rename(hidden, f"manifests/{made['version']:010d}.json")

    def _rename(self, hidden: str, name: str) -> None:
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)  # not: overwrite
        try:
            context.rename(context.makeQualified(self._at(hidden)), context.makeQualified(self._at(name)), none)
        except Exception as e:
            if self._fs.exists(self._at(name)):
                self._fs.delete(self._at(hidden), False)
                raise Conflict(name) from e
            raise

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> str:
        """A folder of rows (with _deleted), bucketed; nobody knows of it yet."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        return folder

    def _add(self, rows: DataFrame, tag: str | None) -> int:
        schema = T.StructType([f for f in rows.schema.fields if f.name != "_deleted"]).json()
        if tag is not None and any(f["tag"] == tag for f in self.manifest()["folders"]):
            return self.manifest()["version"]
        folder = self._write(rows)
        while True:
            now = self.manifest()
            if now["schema"] is not None and now["schema"] != schema:
                raise ValueError("the rows have other columns than the table")
            made = {"version": now["version"] + 1, "schema": schema, "folders": [*now["folders"], {"folder": folder, "kind": "delta", "tag": tag}]}
            try:
                self._commit(made)
                return made["version"]
            except Conflict:
                continue

    def upsert(self, rows: DataFrame, tag: str | None = None) -> int:
        """Add rows; the version that holds them."""
        return self._add(rows.withColumn("_deleted", F.lit(False)), tag)

    def delete(self, keys: DataFrame, tag: str | None = None) -> int:
        """Add tombstones for rows of (keys, order); the version that holds them. Later rows of a key bring it back."""
        named = T.StructType.fromJson(json.loads(self.manifest()["schema"]))
        rows = keys.select(*[F.col(f.name).cast(f.dataType) if f.name in (*self.keys, self.order) else F.lit(None).cast(f.dataType).alias(f.name) for f in named.fields])
        return self._add(rows.withColumn("_deleted", F.lit(True)), tag)

    def _rows(self, manifest: dict, where: Column | None = None) -> DataFrame:
        """The last row of each key of a version, tombstones too."""
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        stored = T.StructType([*schema.fields, T.StructField("_deleted", T.BooleanType()), T.StructField("_bucket", T.IntegerType())])
        parts = []
        for k, f in enumerate(manifest["folders"]):
            part = self.spark.read.schema(stored).parquet(f"{self.path}/{f['folder']}")
            parts.append((part if where is None else part.where(where)).withColumn("_at", F.lit(k)))
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        rest = [f.name for f in schema.fields if f.name not in self.keys]
        rank = F.struct(self.order, "_at", "_deleted", F.struct(*rest))
        last = every.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "_deleted"), rank).alias("_r"))
        return last.select(*[c if c in self.keys else f"_r.{c}" for c in schema.fieldNames()], F.col("_r._deleted").alias("_deleted"))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, else of the last one; what is written later does not show."""
        found = self.manifest(version)
        if not found["folders"]:
            raise FileNotFoundError(f"{self.path} holds no table")
        return self._rows(found).where("NOT _deleted").drop("_deleted")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys (few); only their buckets are read."""
        found = self.manifest()
        buckets = [r[0] for r in keys.select(self._bucket()).distinct().collect()]  # as many as there are buckets at most
        rows = self._rows(found, F.col("_bucket").isin(buckets)).where("NOT _deleted").drop("_deleted")
        wanted = keys.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        return rows.join(wanted, same, "left_semi")

    def compact(self) -> int:
        """One base in place of all folders of the last version; folders that come in meanwhile stay behind it. Removes nothing."""
        covered = self.manifest()
        if not covered["folders"]:
            return covered["version"]
        base = self._write(self._rows(covered).where("NOT _deleted"))
        tags = [f["tag"] for f in covered["folders"] if f["tag"]]
        names = {f["folder"] for f in covered["folders"]}
        while True:
            now = self.manifest()
            if not names <= {f["folder"] for f in now["folders"]}:  # compacted by another writer: ours is left to vacuum
                return now["version"]
            later = [f for f in now["folders"] if f["folder"] not in names]
            made = {"version": now["version"] + 1, "schema": now["schema"], "folders": [{"folder": base, "kind": "base", "tag": tags[-1] if tags else None}, *later]}
            try:
                self._commit(made)
                return made["version"]
            except Conflict:
                continue

    def vacuum(self, keep: int = 2) -> int:
        """Remove older manifests than the last keep, then all that no manifest left lists; how many entries went.

        Not while a writer is at work: its folder is not listed yet.
        """
        known = self.versions()
        gone = 0
        for v in known[:-keep]:
            gone += bool(self._fs.delete(self._at(f"manifests/{v:010d}.json"), False))
        listed = {f["folder"].split("/")[1] for v in known[-keep:] for f in self.manifest(v)["folders"]}
        for at, kept in (("data", listed), ("manifests", {f"{v:010d}.json" for v in known[-keep:]})):
            for f in self._fs.listStatus(self._at(at)) if self._fs.exists(self._at(at)) else []:
                if f.getPath().getName() not in kept:
                    gone += bool(self._fs.delete(f.getPath(), True))
        return gone
