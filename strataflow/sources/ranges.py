"""Records of CSV files whose fields hold line breaks, read by byte ranges instead of a file at a time.

A line break ends a record where the quotes before it in the file are even in number. The quotes of each range are counted
in parallel, the sum of those before a range tells whether it starts within quotes, and each range is then cut into
records on its own. Of a record that crosses a border each range gives its piece; only these pieces are shuffled.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE, BREAK, RETURN = 0x22, 0x0A, 0x0D
#: Ranges known to each task, some 40 bytes each: at 128 MB a range, 500 TB.
MAX_RANGES = 4_000_000


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int, int], np.ndarray, np.ndarray]]:
    """Of each range in a batch (file, start, length, line): its bytes with a break after each line, and the ends of lines in them."""
    if not batch.num_rows:
        return
    place, size, line = (batch.column(i) for i in (1, 2, 3))
    file = batch.column(0).dictionary_encode()
    names, which = file.dictionary.to_pylist(), file.indices.to_numpy()
    starts, lengths = place.to_numpy(), size.to_numpy()
    change = np.flatnonzero((which[1:] != which[:-1]) | (starts[1:] != starts[:-1])) + 1
    for s, e in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
        raw = b"\n".join(line.slice(s, e - s).to_pylist()) + b"\n"
        ends = np.cumsum(pa.compute.binary_length(line.slice(s, e - s)).to_numpy().astype(np.int64) + 1)
        yield (names[which[s]], int(starts[s]), int(lengths[s])), np.frombuffer(raw, np.uint8), ends


def _odd_ends(data: np.ndarray, ends: np.ndarray, before: int) -> np.ndarray:
    """Of each end of a line whether an odd number of quotes stands before it, ``before`` counted in."""
    return (np.searchsorted(np.flatnonzero(data == QUOTE), ends) + before) & 1 == 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range the number of quotes, and whether a record ends in it if it starts within quotes."""
    found: dict[tuple[str, int, int], list] = {}
    for batch in batches:
        for place, data, ends in _segments(batch):
            seen = found.setdefault(place, [0, False])
            seen[1] = seen[1] or bool(_odd_ends(data, ends, seen[0]).any())
            seen[0] += int(np.count_nonzero(data == QUOTE))
    rows = [(*place, *seen) for place, seen in found.items()]
    yield pa.RecordBatch.from_pylist([dict(zip(("file", "start", "length", "quotes", "closes"), r)) for r in rows], schema=_COUNTED)


_COUNTED = pa.schema([("file", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("quotes", pa.int64()), ("closes", pa.bool_())])


def _check_quotes(data: np.ndarray, before: int, separator: int, place: tuple) -> None:
    """Raise where a quote neither borders on the end of a field nor is one of two: the count of quotes tells nothing there."""
    at = np.flatnonzero(data == QUOTE)
    opening = (np.arange(len(at)) + before) & 1 == 0
    left = np.where(at > 0, data[at - 1], BREAK)[opening]
    right, after = data[at + 1][~opening], data[np.minimum(at + 2, len(data) - 1)][~opening]
    fine = np.isin(left, (separator, BREAK, QUOTE)).all()
    if not fine or not (np.isin(right, (separator, BREAK, QUOTE)) | ((right == RETURN) & (after == BREAK))).all():
        raise ValueError(f"{place[0]}: a quote within an unquoted field near byte {place[1]}; read it with multi_line=True")


def _cut(
    batches: Iterator[pa.RecordBatch], known: dict, names: list[str], separator: str, pieces: bool
) -> Iterator[pa.RecordBatch]:
    """The whole records of each range, or the pieces of those that cross a border: (file, opener, start, record)."""
    place, rest, odd, header, head = None, [], 0, False, False
    file, opener, start, record = [], [], [], []

    def piece(which: int, raw: bytes) -> None:
        if pieces:
            file.append(place[0]), opener.append(which), start.append(place[1]), record.append(raw)

    def leave() -> None:
        """The piece that a range ends with: all of it, or the begin of a record that goes on in the next range."""
        if place is None or not rest:
            return
        if header:
            raise ValueError(f"{place[0]}: the header does not end in the first range")
        piece(known[place][1] if head else place[1], b"".join(rest))

    for batch in batches:
        for now, data, ends in _segments(batch):
            if now != place:
                leave()
                if now not in known:
                    raise RuntimeError(f"{now[0]}: files or settings have changed since the frame was built; read it again")
                place, rest, odd = now, [], known[now][0]
                header, head = now[1] == 0, bool(odd)
            _check_quotes(data, odd, ord(separator), place)
            closed = ends[~_odd_ends(data, ends, odd)]
            odd = (odd + int(np.count_nonzero(data == QUOTE))) & 1
            raw = data.tobytes()
            bounds = [0, *closed.tolist()]
            for s, e in zip(bounds, bounds[1:]):
                whole = b"".join([*rest, raw[s:e]])
                rest = []
                if head:
                    head = False
                    piece(known[place][1], whole)
                    continue
                whole = whole[:-2] if whole.endswith(b"\r\n") else whole[:-1]
                if not whole:
                    continue  # as readers of whole files do
                if header:
                    header = False
                    _check_header(whole, names, separator, place[0])
                elif not pieces:
                    record.append(whole)
            if bounds[-1] < len(raw):
                rest.append(raw[bounds[-1] :])
        if record:
            yield _out(file, opener, start, record, pieces)
            file, opener, start, record = [], [], [], []
    leave()
    if record:
        yield _out(file, opener, start, record, pieces)


def _out(file: list, opener: list, start: list, record: list, pieces: bool) -> pa.RecordBatch:
    texts = pa.array(record, pa.binary())
    if not pieces:
        return pa.RecordBatch.from_arrays([texts], ["record"])
    columns = [pa.array(file, pa.string()), pa.array(opener, pa.int64()), pa.array(start, pa.int64()), texts]
    return pa.RecordBatch.from_arrays(columns, ["file", "opener", "start", "record"])


def _check_header(raw: bytes, names: list[str], separator: str, file: str) -> None:
    found = next(csv.reader([raw.decode("utf-8", "replace")], delimiter=separator))
    if [x.lower() for x in found] != [x.lower() for x in names]:
        raise ValueError(f"{file}: the header has {found}, the schema {names}")


def _borders(counted: DataFrame) -> dict[tuple[str, int, int], tuple[int, int]]:
    """Of each range: whether it starts within quotes, and the start of the range in which the record open there begins."""
    rows = counted.orderBy("file", "start").limit(MAX_RANGES + 1).toArrow().to_pylist()
    if len(rows) > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges: set a larger spark.sql.files.maxPartitionBytes")
    total: dict[str, int] = {}
    for r in rows:
        total[r["file"]] = total.get(r["file"], 0) + r["quotes"]
    if odd_files := [file for file, quotes in total.items() if quotes & 1]:
        raise ValueError(f"{odd_files[0]}: an odd number of quotes; read it with multi_line=True")
    known, file, quotes, opener = {}, None, 0, 0
    for r in rows:
        if r["file"] != file:
            file, quotes, opener = r["file"], 0, r["start"]
        odd = quotes & 1
        known[r["file"], r["start"], r["length"]] = odd, opener
        if not odd or r["closes"]:
            opener = r["start"]
        quotes += r["quotes"]
    return known


def csv_records(spark: SparkSession, path: str | list[str], names: list[str], separator: str = ",", **options: str | bool) -> DataFrame:
    """(record): the text of each record below the headers, which must be ``names``; line breaks may stand within quotes.

    A file is cut into as many tasks as Spark's text source makes of it. Quotes are doubled within quotes. A quote anywhere
    else raises, since it cannot be told from one that opens a field by its number, and so does a quote that is not closed. Files must not change until the frame has been
    used, nor the settings that say how Spark cuts them (where executors come and go, set ``spark.sql.files.minPartitionNum``): a range
    that was not counted raises. The bytes are read three times, once of them when the frame is built. Empty
    files and empty lines give no records, equal records one each; no files is an error of the reader's.

    To the driver comes a row per range. A record longer than a range is put together in one task from its pieces, as its row is one value.
    """
    lines = spark.read.options(**options).option("lineSep", "\n").text(path)
    # a file may lack columns of its own, the hidden ones tell the range
    place = [F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "length"))]
    lines = lines.select(*place, F.col("value").cast("binary").alias("line"))
    counted = lines.mapInArrow(_count, "file string, start bigint, length bigint, quotes bigint, closes boolean")
    known = spark.sparkContext.broadcast(_borders(counted))
    whole = lines.mapInArrow(lambda b: _cut(b, known.value, names, separator, False), "record binary")
    whole = whole.select(F.col("record").cast("string").alias("record"))
    if not any(odd for odd, _ in known.value.values()):
        return whole
    parts = lines.mapInArrow(lambda b: _cut(b, known.value, names, separator, True), "file string, opener bigint, start bigint, record binary")
    inside = F.array_sort(F.collect_list(F.struct("start", "record")))
    joined = parts.groupBy("file", "opener").agg(F.concat_ws("", F.transform(inside, lambda p: p["record"].cast("string"))).alias("record"))
    return whole.unionByName(joined.select(F.regexp_replace("record", r"\r?\n\z", "").alias("record")))
