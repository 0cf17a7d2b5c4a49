"""A table of one row per key that late and corrected records are merged into.

Rows lie in a fixed number of buckets by a hash of their key. A commit writes only the
buckets its changes fall into, each to a new folder, and then one manifest that names
the folder of every bucket. Readers open one manifest, so they see one state of the
table whatever is being written; files of other buckets stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.ranking import keep_first
from cohortloom.sources.files import CommitConflict, Files

__all__ = ["CommitConflict", "Manifest", "SnapshotTable"]
BUCKET = "_bucket"


@dataclass(frozen=True)
class Manifest:
    """``folders`` has the folder of each bucket that has rows, below the table's root."""

    version: int
    buckets: int
    keys: list[str]
    order: list[str]
    schema: dict
    folders: dict[str, str] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class SnapshotTable:
    """``keys`` name a row; of several records of a key the one with the largest ``order``
    columns stays, nulls being smallest, ties settled by the other columns."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str],
               order: Sequence[str], buckets: int) -> SnapshotTable:
        table = cls(spark, root)
        table._publish(Manifest(0, buckets, list(keys), list(order), json.loads(schema.json())))
        return table

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names("manifests")
                      if n.removesuffix(".json").isdigit() and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.versions()[-1] if version is None else version
        return Manifest(**json.loads(self.files.read(f"manifests/{version:012d}.json")))

    def _publish(self, manifest: Manifest) -> None:
        self.files.create(f"manifests/{manifest.version:012d}.json", json.dumps(asdict(manifest)))

    def _rows(self, manifest: Manifest, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], manifest.struct)
        return self.spark.read.schema(manifest.struct).parquet(
            *(f"{self.files.root}/{x}" for x in folders))

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, by default the newest."""
        manifest = self.manifest(version)
        return self._rows(manifest, sorted(manifest.folders.values()))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys, from the buckets these fall into."""
        manifest = self.manifest()
        wanted = keys.select(*manifest.keys).distinct()
        touched = self._touched(wanted.withColumn(BUCKET, bucket_of(manifest.keys, manifest.buckets)))
        folders = [manifest.folders[b] for b in touched if b in manifest.folders]
        return self._rows(manifest, folders).join(wanted, manifest.keys, "left_semi")

    @staticmethod
    def _touched(bucketed: DataFrame) -> list[str]:
        """The numbers of the buckets, at most all of them."""
        return [str(r[0]) for r in bucketed.select(BUCKET).distinct().collect()]

    def upsert(self, changes: DataFrame, deleted: str | None = None) -> Manifest:
        """Merge records into the table and commit; returns the new manifest.

        A record older than the one in the table changes nothing, however late it comes;
        applying the same changes twice neither. Records whose ``deleted`` column is true
        take their key out; it leaves no trace, so an older record that comes after
        it is taken as new. Records with a null in a key are refused by an error.
        Records of one key meet in one task, reduced to one per task before. The
        table's other columns must all be in ``changes``, more are not kept.
        """
        base = self.manifest()
        names = base.struct.names
        gone = F.lit(False) if deleted is None else F.coalesce(F.col(deleted), F.lit(False))
        order = [F.col(c).desc_nulls_last() for c in base.order]
        new = changes.select(*(F.col(f.name).cast(f.dataType) for f in base.struct),
                             gone.alias("_gone"))
        new = new.withColumn(BUCKET, bucket_of(base.keys, base.buckets)).withColumn("_newer", F.lit(1))
        nulls = F.count_if(F.greatest(*(F.col(k).isNull().cast("int") for k in base.keys), F.lit(0)) == 1)
        if new.agg(nulls).first()[0]:
            raise ValueError(f"a record without {', '.join(base.keys)}")
        touched = self._touched(new)
        old = self._rows(base, [base.folders[b] for b in touched if b in base.folders])
        old = old.withColumns({"_gone": F.lit(False), BUCKET: bucket_of(base.keys, base.buckets),
                               "_newer": F.lit(0)})
        # At equal order the record of the changes counts.
        merged = keep_first(old.unionByName(new), base.keys, [*order, F.col("_newer").desc()],
                            within=[BUCKET]).where("not _gone")
        commit = f"data/{uuid.uuid4().hex}"
        merged.select(*names, BUCKET).write.partitionBy(BUCKET).parquet(f"{self.files.root}/{commit}")
        written = {n.split("=")[1] for n in self.files.names(commit) if n.startswith(f"{BUCKET}=")}
        folders = {b: f for b, f in base.folders.items() if b not in touched}
        folders |= {b: f"{commit}/{BUCKET}={b}" for b in written}
        after = replace(base, version=base.version + 1, folders=folders)
        self._publish(after)
        return after

    def expire(self, keep: int = 2) -> list[str]:
        """Forget all but the newest ``keep`` versions; folders that no kept version names
        are deleted. Not to be run beside a commit. Returns the deleted folders."""
        versions = self.versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        named = {f for m in kept for f in m.folders.values()}
        for version in versions[:-keep]:
            self.files.delete(f"manifests/{version:012d}.json")
        dead = []
        for commit in self.files.names("data"):
            for part in self.files.names(f"data/{commit}"):
                folder = f"data/{commit}/{part}"
                if part.startswith(f"{BUCKET}=") and folder not in named:
                    self.files.delete(folder)
                    dead.append(folder)
        return dead
