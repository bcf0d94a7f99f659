"""Micro-batch ingest, features and scoring."""

from strataflow.streaming.layers import LayerStream
from strataflow.streaming.queries import await_any, console, for_each_batch, stream_id, to_table
from strataflow.streaming.sparse import SparseLayerStream

__all__ = ["LayerStream", "SparseLayerStream", "await_any", "console", "for_each_batch", "stream_id", "to_table"]
