"""The run ledger: append-only parquet tables of runs, versions, tags, aliases and notes."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkgate import defaults
from chunkgate.operators import ledger as questions

SCHEMAS = {
    "runs": """run_id string, model_name string, status string, start_time timestamp,
        model_kind string, raw_data_hash string, dataset_content_hash string, config_hash string,
        code_version string, candidate_mae double, delta_observed double, ci_low double,
        ci_high double, promote boolean, decision string, config string,
        failure struct<error_type:string,error:string,raw_path:string>,
        raw_rows bigint, null_rows bigint, unparseable_rows bigint, duplicate_rows bigint""",
    "versions": "model_name string, version bigint, run_id string, model_path string, signature string, model_digest string",
    "version_tags": "model_name string, version bigint, tag string, stamp timestamp, note string, event_time timestamp",
    "alias_events": "model_name string, alias string, version bigint, event_time timestamp, seq bigint",
    "annotations": "run_id string, name string, text string, event_time timestamp",
}


@dataclass(frozen=True)
class Ledger:
    """Tables below one folder. One writer at a time; any number of readers."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        schema = T._parse_datatype_string(SCHEMAS[table])
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def append(self, table: str, rows: DataFrame) -> None:
        """Append rows; columns that they lack are null."""
        schema = T._parse_datatype_string(SCHEMAS[table])
        given = {f.name: F.col(f.name) if f.name in rows.columns else F.lit(None) for f in schema}
        rows.select(*[given[f.name].cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(
            self.path(table)
        )

    def append_row(self, table: str, **values) -> None:
        schema = T._parse_datatype_string(SCHEMAS[table])
        row = tuple(values.get(f.name) for f in schema)
        self.append(table, self.spark.createDataFrame([row], schema).coalesce(1))

    def state(self) -> DataFrame:
        return questions.version_state(self.read("versions"), self.read("version_tags"))

    def champion(self, model_name: str):
        """The version row that holds the champion alias, or None on a cold start."""
        events = self.read("alias_events").filter(F.col("model_name") == model_name)
        alias = questions.current_alias(events).first()
        if alias is None:
            return None
        row = self.state().filter((F.col("model_name") == model_name) & (F.col("version") == alias["version"])).first()
        if row is None:
            raise LookupError(f"{model_name}: champion version {alias['version']} is not registered")
        return row

    def has_finished(self, digest: str) -> bool:
        done = (F.col("status") == questions.FINISHED) & (F.col("raw_data_hash") == digest)
        return not self.read("runs").filter(done).isEmpty()

    def next_version(self, model_name: str) -> int:
        mine = self.read("versions").filter(F.col("model_name") == model_name)
        return (mine.agg(F.max("version")).first()[0] or 0) + 1

    def register(self, model_name: str, version: int, run_id: str, model_path: str, signature: str | None = None, model_digest: str | None = None) -> None:
        self.append_row(
            "versions", model_name=model_name, version=version, run_id=run_id, model_path=model_path, signature=signature, model_digest=model_digest
        )

    def tag(self, model_name: str, version: int, tag: str, when: datetime, note: str | None = None) -> None:
        self.append_row(
            "version_tags", model_name=model_name, version=version, tag=tag, stamp=when, note=note, event_time=when
        )

    def point_alias(self, model_name: str, version: int, when: datetime) -> None:
        """Move the champion alias. Written last, so no reader sees half a promotion."""
        self.append_row(
            "alias_events", model_name=model_name, alias=defaults.CHAMPION_ALIAS, version=version,
            event_time=when, seq=time.time_ns(),
        )
