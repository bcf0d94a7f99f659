"""One stream into bronze, silver and gold with features of any number of categories, looked up in a stored table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strataflow.functions.columns import all_present, column
from strataflow.functions.messages import decode_json
from strataflow.operators.categories import CategoryTable, sparse_features
from strataflow.operators.table_classifier import TableClassifier
from strataflow.sources.catalog import create_database, create_table, write_batch
from strataflow.spec import FeatureSpec, Layers
from strataflow.streaming.queries import for_each_batch, stream_id

FEATURES = T.StructType(
    [T.StructField("size", T.LongType()), T.StructField("indices", T.ArrayType(T.LongType())), T.StructField("values", T.ArrayType(T.DoubleType()))]
)


@dataclass(frozen=True)
class SparseLayerStream:
    """As ``LayerStream``, with one sparse vector per row instead of a column per category, so without a limit of categories.

    ``versions`` are fitted state and model (or None) by the first batch that they hold for, from batch 0 on. A batch that comes again
    takes the version that it had, so a new one is added for batches to come and none is taken away. Silver and gold have
    the first batch of a row's version as ``fitted_since``, since places mean something within a version only.

    Bronze has all rows as text. Silver has the keys and the features of all rows: unknown and missing categories give zeros, a row that lacks
    a number, or has a text that is none, has null features. Gold has the rows with features and all keys, and their class.
    Rows that repeat stay. Without a model there is no gold.
    """

    fields: Sequence[str]
    spec: FeatureSpec
    layers: Layers
    versions: Mapping[int, tuple[CategoryTable, TableClassifier | None]]
    on_bad: str = "null"

    def version(self, batch_id: int) -> int:
        """The first batch of the version that holds for a batch."""
        since = [first for first in self.versions if first <= batch_id]
        if not since:
            raise ValueError(f"no version holds for batch {batch_id}")
        return max(since)

    def create_tables(self, spark: SparkSession) -> None:
        text = [T.StructField(name, T.StringType()) for name in self.fields]
        keys = [T.StructField(name, T.StringType()) for name in self.spec.keys]
        since = T.StructField("fitted_since", T.LongType())
        tables = {"bronze": text, "silver": [*keys, T.StructField("features", FEATURES), since]}
        labels = {model.label for _, model in self.versions.values() if model}
        if len(labels) > 1 or labels and any(model is None for _, model in self.versions.values()):
            raise ValueError("all versions have a model of one label, or none has")
        tables |= {"gold": [*text, T.StructField(name, T.LongType()), since] for name in labels}
        create_database(spark, self.layers.database)
        for layer, columns in tables.items():
            create_table(spark, self.layers.table(layer), T.StructType(columns), self.layers.fmt)

    def write(self, batch: DataFrame, batch_id: int, stream: str) -> None:
        """One decoded micro-batch into the tables."""
        first = self.version(batch_id)
        fitted, model = self.versions[first]
        since = F.lit(first).cast("bigint").alias("fitted_since")
        rows = batch.select(*map(column, self.fields)).persist(StorageLevel.MEMORY_AND_DISK)
        encoded = sparse_features(rows, fitted, self.fields, "__features", "ignore", self.on_bad, "encode").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            silver = encoded.select(*map(column, self.spec.keys), F.col("__features").alias("features"), since)
            frames = {"bronze": rows, "silver": silver}
            if model:
                whole = encoded.where(F.col("__features").isNotNull() & all_present(encoded.schema, self.spec.keys))
                frames["gold"] = model.predict(whole, fitted, self.fields, "__features").select("*", since)
            for layer, frame in frames.items():
                write_batch(frame, self.layers.table(layer), self.layers.fmt, stream, batch_id)
        finally:
            encoded.unpersist()
            rows.unpersist()

    def start(self, messages: DataFrame, checkpoint: str, available_now: bool = False, every: str | None = None) -> StreamingQuery:
        """Start the stream from JSON messages in ``value``."""
        if not self.layers.fmt.streamed:
            raise ValueError("the layers need a streamed TableFormat")
        self.create_tables(messages.sparkSession)
        name = stream_id(checkpoint)
        work = lambda batch, batch_id: self.write(batch, batch_id, name)
        return for_each_batch(decode_json(messages, self.fields), work, checkpoint, available_now, every)
