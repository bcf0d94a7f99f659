"""Quality rules by compression: repetitive or incompressible text lies outside a band of zstandard ratios.

The ratio is compressed bytes over bytes, for the whole text and for each fixed chunk of it. A short text cannot
be compressed as well as a long one, so the limits depend on the length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.arrays import slices

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio by size in bytes, and the rule for chunks.

    ``sizes`` are lower ends of the bands, the first 0. A text is rejected if its ratio is below ``low`` or
    above ``high`` of its band, or if more than ``most_chunks`` of its chunks are outside their band. The last chunk
    holds the rest of the text if that is at least half a chunk, else the rest belongs to the chunk before.
    """

    sizes: tuple[int, ...] = (0, 128, 256, 512, 1024, 2048, 4096)
    low: tuple[float, ...] = (0.0, 0.30, 0.28, 0.26, 0.24, 0.22, 0.20)
    high: tuple[float, ...] = (1.5, 1.0, 0.92, 0.85, 0.80, 0.76, 0.72)
    chunk_bytes: int = 4096
    most_chunks: float = 0.5
    level: int = 3


BASE_MIN_WORDS = 50

OUT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
    "kept boolean, ratio double, n_chunks bigint, n_chunks_low bigint, n_chunks_high bigint"
)


def repeated_words(found: list[bytes]) -> int:
    """Words in windows of three that stand at least twice in the text, overlapping windows included."""
    n = len(found)
    if n < 4:
        return 0
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, found), dtype=np.int64, count=n)
    size = len(numbers)
    if size >= 1 << 21:  # three numbers no longer fit in one
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * size + ids[2:]
    else:
        windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= again
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    found = text.split()  # bytes split at the six ASCII blanks only
    letters = text.translate(None, BLANKS)
    points = len(letters) if letters.isascii() else len(letters.decode("utf-8", "replace"))
    symbols = len(letters) - len(letters.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(found), points, symbols, len(lines) - len(set(lines)), repeated_words(found)


def _chunk_ends(size: int, chunk: int) -> list[int]:
    ends = list(range(chunk, size, chunk))
    if ends and size - ends[-1] < chunk / 2:
        ends.pop()
    return [*ends, size] if size else []


def verdict(text: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple[bool, float | None, int, int, int]:
    """Whether the text lies in the bands; its ratio; its chunks, and how many are below and above theirs."""
    if not text:
        return False, None, 0, 0, 0

    def band(size: int) -> tuple[float, float]:
        at = int(np.searchsorted(bands.sizes, size, side="right")) - 1
        return bands.low[at], bands.high[at]

    ratio = len(compressor.compress(text)) / len(text)
    low, high = band(len(text))
    ends = _chunk_ends(len(text), bands.chunk_bytes)
    below = above = 0
    for start, end in zip([0, *ends[:-1]], ends):
        part = ratio if len(ends) == 1 else len(compressor.compress(text[start:end])) / (end - start)
        part_low, part_high = band(end - start)
        below += part < part_low
        above += part > part_high
    inside = low <= ratio <= high and below + above <= bands.most_chunks * len(ends)
    return inside, ratio, len(ends), below, above


def _judge(batches: Iterator[pa.RecordBatch], bands: Bands, keep: bool) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=bands.level, write_checksum=False, write_content_size=False)
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(batch.num_columns - 1)):
            rows = []
            everything = data.tobytes()
            for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                text = everything[start:stop]
                counts = base_counts(text)
                failed = counts[0] < BASE_MIN_WORDS or 100 * counts[4] > 50 * counts[0]
                inside, *figures = verdict(text, bands, compressor)
                rows.append((*counts, failed, inside and not failed, *figures))
            arrays = [batch.column(0).slice(first, end - first)] if keep else []
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 3
            arrays += [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            names = (["doc_id"] if keep else []) + [c.split()[0] for c in OUT.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names)


def compression_bands(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bands: Bands = Bands()
) -> DataFrame:
    """One row per document: its id, counts of its words, ratios, and whether it is kept.

    A document fails the base rules with fewer than 50 words, or when over half of its words are in
    three-word windows that it repeats; else the bands decide. A null text is empty: no words, no ratio, not
    kept. Rows that repeat are judged each. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(lambda batches: _judge(batches, bands, True), f"doc_id {kind}, {OUT}")
