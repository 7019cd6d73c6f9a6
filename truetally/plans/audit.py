"""The audit log of answered questions: an append-only table, one commit per run."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from truetally.sources.commits import committed, discard, put_if_absent
from truetally.sources.schemas import AUDIT_SCHEMA
from truetally.sources.tables import ensure_columns


class AuditLog:
    """Audit rows in a folder of the shared file system, partitioned by day.

    A run stages its rows in a folder of its own and then commits one file named
    by its run id. A run that is repeated, after success or a loss half-way,
    finds its id taken and adds nothing, or commits what the first try could
    not; rows that no commit names are never read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, rows: DataFrame, run_id: str) -> bool:
        """Append a run's rows (columns of AUDIT_SCHEMA, missing ones null); False if the run is in the log already."""
        name = f"run-{hashlib.sha256(run_id.encode()).hexdigest()[:32]}.json"
        if name in committed(self.spark, f"{self.root}/runs"):
            return False
        write = uuid.uuid4().hex
        path = f"{self.root}/data/write={write}"
        (ensure_columns(rows, AUDIT_SCHEMA).select(*AUDIT_SCHEMA.names).withColumn("day", F.to_date("logged_at"))
         .hint("rebalance", "day").sortWithinPartitions("day", "logged_at")  # a busy day spreads over tasks by its size
         .write.partitionBy("day").parquet(path))
        if put_if_absent(self.spark, f"{self.root}/runs/{name}", json.dumps({"run_id": run_id, "write": write})):
            return True
        discard(self.spark, path)
        return False

    def read(self) -> DataFrame:
        """All committed rows, with ``day``; a filter on it prunes directories."""
        runs = [f"{self.root}/runs/{n}" for n in committed(self.spark, f"{self.root}/runs")]
        schema = StructType([*AUDIT_SCHEMA.fields, StructField("day", DateType()), StructField("write", StringType())])
        if not runs:
            return self.spark.createDataFrame([], schema).drop("write")
        writes = [r.write for r in self.spark.read.schema("write string").json(runs).collect()]  # one per run
        base = f"{self.root}/data"
        return (self.spark.read.schema(schema).option("basePath", base)
                .parquet(*[f"{base}/write={w}" for w in writes]).drop("write"))
