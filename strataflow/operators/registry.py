"""Versions of named models, and the metrics of the runs that made them."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.classifier import LinearClassifier
from strataflow.sources.catalog import append, create_database, create_table
from strataflow.spec import TableFormat

MODEL_COLUMNS = "model string, version int, run_id string, path string, vectors boolean, ts timestamp"
RUN_COLUMNS = "run_id string, experiment string, model string, metric string, value double, ts timestamp"


@dataclass(frozen=True)
class Registry:
    """Models under ``root/name/v1, v2, ...`` and the tables ``models`` and ``runs`` of a database."""

    database: str
    root: str
    fmt: TableFormat = TableFormat()

    def create(self, spark: SparkSession) -> None:
        create_database(spark, self.database)
        create_table(spark, f"{self.database}.models", MODEL_COLUMNS, self.fmt)
        create_table(spark, f"{self.database}.runs", RUN_COLUMNS, self.fmt)

    def log_metric(
        self, spark: SparkSession, experiment: str, model: str, metric: str, value: float, run_id: str | None = None
    ) -> str:
        """Add a metric to a run, a new one by default; returns the run's id."""
        run_id = run_id or uuid.uuid4().hex
        row = (run_id, experiment, model, metric, float(value), dt.datetime.now(dt.timezone.utc))
        append(spark.createDataFrame([row], RUN_COLUMNS).coalesce(1), f"{self.database}.runs", self.fmt)
        return run_id

    def register(self, spark: SparkSession, model: LinearClassifier, name: str, run_id: str | None = None) -> int:
        """Save the model as the next version of ``name``; an existing version is never replaced."""
        version = self.latest(spark, name) + 1
        while True:
            path = f"{self.root}/{name}/v{version}"
            try:
                model.save(spark, path)
                break
            except AnalysisException as error:
                if "PATH_ALREADY_EXISTS" not in str(error):
                    raise
                version += 1
        row = (name, version, run_id, path, model.vectors is not None, dt.datetime.now(dt.timezone.utc))
        append(spark.createDataFrame([row], MODEL_COLUMNS).coalesce(1), f"{self.database}.models", self.fmt)
        return version

    def latest(self, spark: SparkSession, name: str) -> int:
        found = self.versions(spark, name).agg(F.max("version").alias("version")).first()["version"]
        return found or 0

    def versions(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"{self.database}.models").filter(F.col("model") == name)

    def runs(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.database}.runs")

    def load(self, spark: SparkSession, name: str, version: int = 1) -> LinearClassifier:
        row = self.versions(spark, name).filter(F.col("version") == version).first()
        if row is None:
            raise ValueError(f"model {name!r} has no version {version}")
        return LinearClassifier.load(spark, row["path"], row["vectors"])
