"""The run log, an append-only parquet table."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import typed
from tidemark.layers import RUN_LOG_SCHEMA
from tidemark.operators.dedupe import latest_per_key
from tidemark.spec import TableSpec

ERROR_LENGTH = 4000


class AuditLog:
    """The run log at ``base/META/RUN_LOG``, one row per table and run.

    It also holds the watermark state: the newest successful load of a table
    says where its next window starts.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.path = f"{base.rstrip('/')}/META/RUN_LOG"

    def write(self, record: dict, inserted_at: datetime) -> None:
        """Append one run; keys are RUN_LOG columns, missing ones are NULL."""
        row = {**record, "RUN_ID": uuid.uuid4().hex, "INSERTED_AT": inserted_at}
        if row.get("ERROR_MESSAGE") is not None:
            row["ERROR_MESSAGE"] = str(row["ERROR_MESSAGE"])[:ERROR_LENGTH]
        # A one-row range with literals stays in the JVM.
        line = self.spark.range(0, 1, 1, 1).select(
            *[typed(row.get(f.name), f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA.fields]
        )
        # Tables run side by side: appends to one folder would share its temporary
        # files, and the first to finish would delete those of the others.
        line.write.mode("errorifexists").parquet(f"{self.path}/{row['BATCH_ID']}/{row['RUN_ID']}")

    def log(self) -> DataFrame:
        try:
            reader = self.spark.read.schema(RUN_LOG_SCHEMA).option("recursiveFileLookup", "true")
            return reader.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RUN_LOG_SCHEMA)  # nothing written yet

    def watermarks(self) -> DataFrame:
        """Newest stored watermark per table."""
        loads = self.log().where(
            (F.col("STATUS") == "success")
            & F.col("LOAD_TYPE").isin("full", "incremental")
            & F.col("WATERMARK_TO").isNotNull()
        )
        newest = latest_per_key(
            loads, ["SOURCE_DB", "SOURCE_TABLE", "TARGET_TABLE"], "INSERTED_AT", tiebreak=["RUN_ID"]
        )
        return newest.select("SOURCE_DB", "SOURCE_TABLE", "TARGET_TABLE", "WATERMARK_TO")

    def stored(self) -> dict[tuple[str, str, str], str]:
        """``watermarks`` as a dictionary: one entry per configured table, so bounded.

        A run reads it once for all its tables.
        """
        return {tuple(row)[:3]: row["WATERMARK_TO"] for row in self.watermarks().collect()}

    def watermark(self, spec: TableSpec) -> str | None:
        return self.stored().get(log_key(spec))


def log_key(spec: TableSpec) -> tuple[str, str, str]:
    return spec.source_db, spec.source_table, spec.target_table
