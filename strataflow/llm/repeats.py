"""Bytes covered by long repeated strings, found by prefix doubling over anchors.

Naming the string at every byte and doubling its length would shuffle all bytes again and again. Here only anchors are
named. The anchor of a position is where the least hash of ``GRAM`` bytes stands in the ``WINDOW`` places from
it on, so equal strings of ``LENGTH`` bytes have their anchors at the same distance, and one anchor stands for
all positions that choose it. Each round groups anchors by the name of a longer string at them, joined from the name
of the round before and that of what follows, and drops those whose name is unique:

1. the ``SHARED`` bytes from the anchor on, which are part of every string that chooses it;
2. the string from the first position that chooses the anchor to the end of the last one's ``LENGTH`` bytes:
   if it is repeated, all these positions are;
3. the ``LENGTH`` bytes at each single position, only for anchors left alone in round 2 whose group of round 1
   has others, and for one anchor of each string repeated in round 2 in these groups.

Names are 64-bit hashes; those of rounds 2 and 3 are joined with that of round 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.arrays import SMALL_SLICE, mix, prefix_hashes, slices, substring_hashes
from strataflow.sources import scratch_path

LENGTH = 400
WINDOW = 256
GRAM = 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def window_minima(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` consecutive values."""
    out, width = values, 1
    while width < window:
        step = min(width, window - width)
        out = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of all positions at which ``length`` bytes of a text begin.

    Returns the text, the place in it, the least and the largest distance from a position to it, and the names of rounds 1 and 2.
    """
    none = np.zeros(0, np.int64)
    shared = length - window + 1
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    pre = prefix_hashes(data)
    starts = np.arange(len(data) - gram + 1)
    grams = substring_hashes(pre, starts, starts + gram)
    # a number holds the hash above and the place below, so the leftmost of equal grams is the least
    values = (grams & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
    least = (window_minima(values, window) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(offsets)
    positions = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), positions)
    first = np.concatenate(([0], np.cumsum(positions)))[:-1]
    at = np.arange(len(owner)) - np.repeat(first, positions) + np.repeat(offsets[:-1], positions)
    chosen = least[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    end = np.concatenate((begin[1:], [len(at)])) - 1 if len(begin) else begin
    place = chosen[begin]
    half = shared // 2
    name = mix(substring_hashes(pre, place, place + half) * _ODD + substring_hashes(pre, place + half, place + shared))
    whole = substring_hashes(pre, at[begin], at[end] + length)
    text = owner[begin]
    return text, place - offsets[text], place - at[end], place - at[begin], name, whole


#: Groups of round 1 with at most so many strings of round 2 are compared within a task, which then holds 13 MB of strings;
#: larger ones are compared by a shuffle of positions.
SMALL_GROUP = 20_000
TASK_BYTES = 4 << 20

ANCHORS = "key bigint, packed bigint, name bigint, whole bigint"


def _pack(place: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return place << 32 | low << 16 | high


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 32, packed >> 16 & 0xFFFF, packed & 0xFFFF


def _signed(names: np.ndarray) -> pa.Array:
    return pa.array(names.view(np.int64))


def _emit_anchors(batches: Iterator[pa.RecordBatch], length: int, window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for first, _, data, offsets in slices(batch.column(1), SMALL_SLICE):
            text, place, low, high, name, whole = anchors(data, offsets, length, window, gram)
            columns = [pa.array(keys[first + text]), pa.array(_pack(place, low, high)), _signed(name), _signed(whole)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "packed", "name", "whole"])


def _emit_strings(batches: Iterator[pa.RecordBatch], length: int, large: bool) -> Iterator[pa.RecordBatch]:
    """For each open anchor of (key, text, opens): its string of round 2, or the names of its positions if its group is large."""
    for batch in batches:
        keys, opens = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        at = 0
        for first, end, data, offsets in slices(batch.column(1), SMALL_SLICE):
            rows = [
                (keys[i], int(offsets[i - first]), o["name"], o["packed"], o["alone"])
                for i in range(first, end)
                for o in opens[i] or ()
                if o["large"] == large
            ]
            at = end
            if not rows:
                continue
            key, base, name, packed, alone = (np.array(c) for c in zip(*rows))
            place, low, high = _unpack(packed)
            if not large:
                raw = data.tobytes()
                strings = [raw[s:e] for s, e in zip((base + place - high).tolist(), (base + place - low + length).tolist())]
                columns = [pa.array(name), pa.array(key), pa.array(packed), pa.array(alone, pa.bool_()), pa.array(strings, pa.binary())]
                for k in range(0, len(rows), 4000):
                    yield pa.RecordBatch.from_arrays([c.slice(k, 4000) for c in columns], ["name", "key", "packed", "alone", "string"])
            else:
                count = high - low + 1
                row = np.repeat(np.arange(len(rows)), count)
                distance = high[row] - (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
                start = place[row] - distance
                names = _position_names(prefix_hashes(data), base[row] + start, distance, name[row], length)
                yield pa.RecordBatch.from_arrays(
                    [_signed(names), pa.array(key[row]), pa.array(start), pa.array(alone[row], pa.bool_())], ["name", "key", "start", "alone"]
                )
        assert at == batch.num_rows


def _position_names(pre: np.ndarray, start: np.ndarray, distance: np.ndarray, name: np.ndarray, length: int) -> np.ndarray:
    within = name.view(np.uint64) * _ODD + distance.astype(np.uint64)
    return mix(substring_hashes(pre, start, start + length) ^ mix(within))


def _repeated_positions(rows: list[pa.RecordBatch], length: int) -> pa.RecordBatch | None:
    """Runs of positions of lone anchors whose strings stand at another anchor of these whole groups."""
    table = pa.Table.from_batches(rows).combine_chunks()
    name, key, packed = (table.column(i).to_numpy() for i in range(3))
    alone = table.column(3).to_numpy(zero_copy_only=False)
    strings = table.column(4).cast(pa.large_binary()).combine_chunks()
    place, low, high = _unpack(packed)
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    count = high - low + 1
    row = np.repeat(np.arange(len(name)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    names = _position_names(prefix_hashes(data), offsets[row] - offsets[0] + step, high[row] - step, name[row], length)
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    found = np.zeros(len(names), dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    hit = np.flatnonzero(found & alone[row])
    if not len(hit):
        return None
    begins = np.concatenate(([True], (np.diff(hit) > 1) | (row[hit[1:]] != row[hit[:-1]])))
    ends = np.concatenate((begins[1:], [True]))
    start = (place - high)[row] + step
    return pa.RecordBatch.from_arrays(
        [pa.array(key[row[hit[begins]]]), pa.array(start[hit[begins]]), pa.array(start[hit[ends]] + length)], ["key", "start", "end"]
    )


def _compare_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by name; groups are compared as soon as they are whole, many at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        names = batch.column(0).to_numpy()
        cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
        if held and len(names) and held[-1].column(0)[-1].as_py() != names[0]:
            cuts = np.concatenate(([0], cuts))
        begin = 0
        for cut in cuts.tolist():
            size += batch.slice(begin, cut - begin).nbytes
            if cut > begin:
                held.append(batch.slice(begin, cut - begin))
            begin = cut
            if size >= TASK_BYTES:
                if (out := _repeated_positions(held, length)) is not None:
                    yield out
                held, size = [], 0
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
            size += held[-1].nbytes
    if held and (out := _repeated_positions(held, length)) is not None:
        yield out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the spans of (doc_id, text, spans, more spans)."""
    for batch in batches:
        out = []
        for text, *spans in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            merged: list[list[int]] = []
            for start, end in sorted((s["start"], s["end"]) for part in spans for s in part or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            digest, at = hashlib.sha256(), 0
            for start, end in merged:
                digest.update(text[at:start])
                at = end
            digest.update(text[at:])
            spans = [{"start": s, "end": e} for s, e in merged]
            out.append((len(text), sum(e - s for s, e in merged), len(merged), digest.hexdigest(), spans))
        kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        )


def _kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table of a round to the shared folder and read it again, so that a lost executor costs no round."""
    df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed ``spans`` in bytes.

    A byte is removed if a string of ``length`` bytes around it also starts anywhere else, in the same document or
    another, also a row that repeats it. Texts are judged as UTF-8 bytes; a null text is empty; texts shorter than
    ``length`` lose nothing. ``window`` + ``gram`` - 1 must not exceed ``length``. Other columns of ``docs`` are not read.

    Documents are known by a 64-bit hash of id and text. Texts are shuffled once, and those that share a string of
    round 1 with another place once more.
    """
    if window + gram - 1 > length:
        raise ValueError("the grams that choose an anchor must lie within the string")
    spark = docs.sparkSession
    folder = scratch_path(spark, "repeats")
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("text")
    ).withColumn("key", F.xxhash64("doc_id", "text"))

    found = _kept(rows.select("key", "text").mapInArrow(lambda b: _emit_anchors(b, length, window, gram), ANCHORS), folder, "anchors")
    # stored, since a join on an aggregate of its own key cannot be split where one name fills a partition
    again = _kept(found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"), folder, "again")
    shared = _kept(found.join(again, "name", "left_semi").select("key", "packed", "name", "whole"), folder, "shared")

    strings = _kept(
        shared.groupBy("name", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "packed")).alias("one")), folder, "strings"
    )
    groups = strings.groupBy("name").agg(F.count(F.lit(1)).alias("strings"), F.sum(F.expr("int(n = 1)")).alias("alone"))
    groups = groups.where("alone > 0 and strings > 1").select("name", (F.col("strings") > SMALL_GROUP).alias("large"))
    groups = _kept(groups, folder, "groups")
    opens = (
        strings.join(groups, "name")
        .select("one.key", F.struct("name", "one.packed", (F.col("n") == 1).alias("alone"), "large").alias("open"))
        .groupBy("key").agg(F.collect_list("open").alias("opens"))
    )
    place, low, high = F.expr("packed >> 32"), F.expr("(packed >> 16) & 65535"), F.expr("packed & 65535")
    covered = (
        shared.join(strings.where("n > 1").select("name", "whole"), ["name", "whole"], "left_semi")
        .select("key", F.struct((place - high).alias("start"), (place - low + length).alias("end")).alias("span"))
        .groupBy("key").agg(F.collect_set("span").alias("spans"))
    )
    marks = covered.join(opens, "key", "full")
    touched = F.col("spans").isNotNull() | F.col("opens").isNotNull()
    texts = rows.join(marks, "key", "left").select(
        "doc_id", "key", "spans", "opens", F.when(touched, F.col("text")).alias("text"),
        F.octet_length("text").cast("bigint").alias("n_bytes"), F.when(~touched, F.sha2("text", 256)).alias("sha"),
    )
    texts = _kept(texts, folder, "texts")

    open_texts = texts.where("opens is not null").select("key", "text", "opens")
    small = (
        open_texts.mapInArrow(lambda b: _emit_strings(b, length, False), "name bigint, key bigint, packed bigint, alone boolean, string binary")
        .repartition("name").sortWithinPartitions("name")
        .mapInArrow(lambda b: _compare_groups(b, length), "key bigint, start bigint, end bigint")
    )
    positions = open_texts.mapInArrow(lambda b: _emit_strings(b, length, True), "name bigint, key bigint, start bigint, alone boolean")
    repeated = positions.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    large = positions.where("alone").join(repeated, "name", "left_semi").select("key", "start", (F.col("start") + length).alias("end"))
    more = small.union(large).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("more"))
    more = _kept(more, folder, "positions")

    span = "spans array<struct<start:bigint,end:bigint>>"
    cut = (
        texts.where("text is not null").join(more, "key", "left").select("doc_id", "text", "spans", "more")
        .mapInArrow(_cut, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, {span}")
    )
    none = F.lit(0).cast("bigint")
    whole = texts.where("text is null").select(
        "doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.col("sha").alias("kept_sha256"), F.array().cast(span.partition(" ")[2]).alias("spans")
    )
    return cut.union(whole)
