"""One stream of raw rows into the bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strataflow.functions.columns import column
from strataflow.functions.messages import MALFORMED, MESSAGE, decode_json, decode_or_keep
from strataflow.operators.classifier import LinearClassifier
from strataflow.operators.features import Preparation
from strataflow.plans.scoring import feature_rows, gold_in_place
from strataflow.session import short_methods
from strataflow.sources.catalog import compact, create_database, create_table, write_batch
from strataflow.spec import FeatureSpec, Layers
from strataflow.streaming.queries import for_each_batch, stream_id


@dataclass(frozen=True)
class LayerStream:
    """Writes each micro-batch to the three tables, in this order, with features and model fitted before.

    The batch is read and decoded once. A row with an unknown or missing category is
    scored with zeros for it; a row without some number is kept in bronze and silver but
    has no prediction, so it is not in gold, and neither is a row without a key. A text that
    is no number counts as missing, so that it does not stop the stream; ``on_bad="error"`` stops it. If a write
    fails, the batch comes again and replaces what it had written.

    A message that is no JSON object gives a row of nulls in bronze. With ``quarantine``, the name of a table beside the
    layers, it goes there instead, as the text it was, and the progress of the query counts messages and malformed ones
    per batch, as the observed metric ``messages``.
    """

    fields: Sequence[str]
    spec: FeatureSpec
    layers: Layers
    preparation: Preparation
    model: LinearClassifier
    on_bad: str = "null"
    quarantine: str | None = None

    def decode(self, messages: DataFrame) -> DataFrame:
        """The fields of JSON messages in ``value``, as text."""
        return decode_json(messages, self.fields)

    def create_tables(self, spark: SparkSession) -> None:
        text = [T.StructField(name, T.StringType()) for name in self.fields]
        keys = [T.StructField(name, T.StringType()) for name in self.spec.keys]
        features = [T.StructField(name, T.DoubleType()) for name in self.preparation.feature_names]
        label = T.StructField(self.model.label, T.LongType())
        create_database(spark, self.layers.database)
        for layer, columns in (("bronze", text), ("silver", keys + features), ("gold", [*text, label])):
            create_table(spark, self.layers.table(layer), T.StructType(columns), self.layers.fmt)
        if self.quarantine:
            create_table(spark, self.quarantine_table, "message STRING", self.layers.fmt)

    def write(self, batch: DataFrame, batch_id: int, stream: str) -> None:
        """One decoded micro-batch into the three tables."""
        rows = batch.select(*map(column, self.fields)).persist(StorageLevel.MEMORY_AND_DISK)
        options = {"on_unknown": "ignore", "incomplete": "encode", "on_bad": self.on_bad}
        try:
            features = feature_rows(rows, self.preparation, self.spec, **options)
            scored = gold_in_place(rows, self.preparation, self.model, self.spec, **options)
            with short_methods(batch.sparkSession):
                for layer, frame in (("bronze", rows), ("silver", features), ("gold", scored)):
                    write_batch(frame, self.layers.table(layer), self.layers.fmt, stream, batch_id)
        finally:
            rows.unpersist()

    def start(
        self,
        messages: DataFrame,
        checkpoint: str,
        available_now: bool = False,
        every: str | None = None,
    ) -> StreamingQuery:
        """Start the stream from JSON messages in ``value``.

        Without transactions in the table format each batch is a partition of the three
        tables, so let batches be minutes apart (``every``) where the stream never ends, and
        merge closed ones by :meth:`compact`.
        """
        if not self.layers.fmt.streamed:
            raise ValueError("the layers need a streamed TableFormat")
        self.create_tables(messages.sparkSession)
        name = stream_id(checkpoint)
        work = lambda batch, batch_id: self.write(batch, batch_id, name)
        if not self.quarantine:
            return for_each_batch(self.decode(messages), work, checkpoint, available_now, every)
        counted = decode_or_keep(messages, self.fields).observe(
            "messages", F.count(F.lit(1)).alias("messages"), F.count_if(F.col(MALFORMED)).alias("malformed")
        )
        work = lambda batch, batch_id: self.write_or_quarantine(batch, batch_id, name)
        return for_each_batch(counted, work, checkpoint, available_now, every)

    @property
    def quarantine_table(self) -> str:
        return f"{self.layers.database}.{self.quarantine}"

    def write_or_quarantine(self, batch: DataFrame, batch_id: int, stream: str) -> None:
        """One micro-batch of :func:`decode_or_keep`: malformed messages into the quarantine, the others into the layers."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bad = batch.where(F.col(MALFORMED)).select(F.col(MESSAGE).alias("message"))
            write_batch(bad, self.quarantine_table, self.layers.fmt, stream, batch_id)
            self.write(batch.where(~F.col(MALFORMED)), batch_id, stream)
        finally:
            batch.unpersist()

    def compact(self, spark: SparkSession, checkpoint: str, through: int) -> None:
        """Merge the batches up to ``through`` of the stream of this checkpoint, in each layer and the quarantine."""
        tables = [self.layers.table(layer) for layer in ("bronze", "silver", "gold")]
        for table in [*tables, self.quarantine_table] if self.quarantine else tables:
            compact(spark, table, stream_id(checkpoint), through)
