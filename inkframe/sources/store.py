"""Immutable artifacts and current pointers as append-only Parquet tables.

An artifact is (artifact_type, artifact_id, revision) with a payload and its hash. Writing the same
again is no change; writing something else under a key is a conflict and nothing is written. A
pointer's log is moved by compare-and-set; the current target is the one of the greatest revision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from inkframe.operators.checks import require_empty
from inkframe.operators.consolidate import latest

ARTIFACTS = "artifact_type string, artifact_id string, revision bigint, schema_version int, content_hash string, payload string"
POINTERS = "pointer_id string, revision bigint, kind string, target_id string, target_revision bigint"


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def artifacts(self) -> DataFrame:
        return self._read("artifacts", ARTIFACTS)

    def put(self, rows: DataFrame) -> int:
        """Append artifacts; rows: artifact_type, artifact_id, revision, schema_version, payload.
        Returns how many are new. Raises on a conflict, also among the rows themselves."""
        key = ["artifact_type", "artifact_id", "revision"]
        new = rows.select(*key, "schema_version", F.sha2(F.concat_ws("|", F.col("schema_version").cast("string"), "payload"), 256).alias("content_hash"), "payload").distinct()
        require_empty(new.groupBy(*key).count().where("count > 1"), "two contents under one key")
        old = self.artifacts().select(*key, F.col("content_hash").alias("old_hash"))
        met = new.join(old, key, "left")
        require_empty(met.where("old_hash is not null and old_hash <> content_hash").drop("payload"), "another content is stored under the key")
        add = met.where("old_hash is null").drop("old_hash")
        n = add.count()
        if n:
            add.write.mode("append").partitionBy("artifact_type").parquet(f"{self.path}/artifacts")
        return n

    def get(self, refs: DataFrame) -> DataFrame:
        """Artifacts of refs (artifact_type, artifact_id, revision, content_hash); all four must agree."""
        return self.artifacts().join(refs, ["artifact_type", "artifact_id", "revision", "content_hash"], "left_semi")

    def next_revision(self, artifact_type: str, artifact_id: str, start: int = 1) -> int:
        """The least unused revision from `start` on."""
        used = self.artifacts().where((F.col("artifact_type") == artifact_type) & (F.col("artifact_id") == artifact_id) & (F.col("revision") >= start)).select("revision").distinct()
        gap = used.join(used.select((F.col("revision") - 1).alias("revision")), "revision", "left_anti").agg(F.min("revision")).first()[0]
        return start if gap is None or not used.where(F.col("revision") == start).head(1) else gap + 1

    def pointers(self) -> DataFrame:
        return self._read("pointers", POINTERS)

    def current(self) -> DataFrame:
        return latest(self.pointers(), ["pointer_id"], ["revision"])

    def compare_and_set(self, pointer_id: str, kind: str, expected: int | None, target_id: str, target_revision: int) -> int:
        """Move a pointer whose current revision is `expected` (None: it has none yet); its new revision.
        Repeating the last move exactly changes nothing. Anything else raises."""
        head = self.current().where(F.col("pointer_id") == pointer_id).head(1)
        at = head[0].revision if head else None
        if head and (head[0].target_id, head[0].target_revision, head[0].kind) == (target_id, target_revision, kind) and expected in (at, at - 1 or None):
            return at
        if at != expected:
            raise ValueError(f"{pointer_id} is at {at}, not at {expected}")
        if head and head[0].kind != kind:
            raise ValueError(f"{pointer_id} is of kind {head[0].kind}")
        row = [(pointer_id, (at or 0) + 1, kind, target_id, target_revision)]
        self.spark.createDataFrame(row, POINTERS).write.mode("append").parquet(f"{self.path}/pointers")
        return (at or 0) + 1


def missing(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed run still has to do: planned rows without an equal one that was done."""
    return plan.join(done.select(*keys).distinct(), keys, "left_anti")
