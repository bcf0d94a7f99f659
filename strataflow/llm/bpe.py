"""Byte-pair encoding with contiguous rank arrays, and decoding.

The short words of many texts are encoded together. A row of a matrix holds the parts of a word, a row of another the
ranks of the merges of adjacent parts. The least rank of each row is looked for, the boundary between its two
parts is deleted, and the ranks on either side are looked up again, until no row has a merge left. Words of more
than ``SHORT`` bytes keep their ranks in a heap, since looking for the least one again and again takes time that
grows with the square of the length; the merges are the same.

A piece of text between two single spaces is encoded the same wherever it stands, so the ids of such pieces
are kept while a task lasts; what is kept has a bound. Python workers outlive their tasks and go on with other operators,
so what a task has learned goes when it ends.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.arrays import slices

VOCABULARY = "byte_bpe_50k.json"
SHORT = 32
KEPT_PIECES = 1 << 18
NONE = np.int64(1 << 40)

OUT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Encodes and decodes with the vocabulary, merges and added tokens of a tokenizer file (its content as text)."""

    def __init__(self, content: str):
        parts = json.loads(content)
        letters = byte_letters()
        vocabulary: dict[str, int] = parts["model"]["vocab"]
        self.pieces = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if all(c in letters for c in token)}
        self.bytes = [vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        merges = [m if isinstance(m, list) else m.split(" ") for m in parts["model"]["merges"]]
        pairs = [(vocabulary[left], vocabulary[right], rank, vocabulary[left + right]) for rank, (left, right) in enumerate(merges)]
        self.merges = {(left, right): (rank, merged) for left, right, rank, merged in pairs}
        table = np.array([(left << 32 | right, rank, merged) for left, right, rank, merged in pairs], dtype=np.int64)
        table = table.reshape(-1, 3)[np.argsort(table.reshape(-1, 3)[:, 0])]
        self.keys, self.ranks, self.merged = (np.ascontiguousarray(table[:, i]) for i in range(3))
        self.added = {token["content"]: token["id"] for token in parts["added_tokens"]}
        self.pieces |= {i: content.encode() for content, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.words: dict[str, bytes] = {}
        self.pieces_between: dict[str, bytes] = {}

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs (``NONE`` if there is no merge) and what they merge to."""
        if not len(self.keys):
            return np.full(left.shape, NONE), np.zeros(left.shape, np.int64)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.merged[at]

    def _short(self, texts: list[bytes]) -> list[bytes]:
        """The ids of words of like length, as little-endian 32-bit numbers."""
        n, width = len(texts), max(map(len, texts))
        raw = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), dtype=np.uint8).reshape(n, width)
        parts = np.array(self.bytes, dtype=np.int64)[raw]
        length = np.fromiter(map(len, texts), dtype=np.int64, count=n)
        column = np.arange(width)
        ranks = np.full((n, width), NONE)
        becomes = np.zeros((n, width), dtype=np.int64)
        if width > 1:
            ranks[:, :-1], becomes[:, :-1] = self._look_up(parts[:, :-1], parts[:, 1:])
            ranks[column[None, :] >= (length - 1)[:, None]] = NONE
        open_rows = np.arange(n)
        while len(open_rows):
            at = ranks[open_rows].argmin(axis=1)
            more = ranks[open_rows, at] < NONE
            open_rows, at = open_rows[more], at[more]
            if not len(open_rows):
                break
            parts[open_rows, at] = becomes[open_rows, at]
            # delete the boundary after ``at``: the part after it goes, and so do the rank and the merge of ``at``
            source = np.minimum(column + (column > at[:, None]), width - 1)
            parts[open_rows] = np.take_along_axis(parts[open_rows], source, axis=1)
            source = np.minimum(column + (column >= at[:, None]), width - 1)
            ranks[open_rows] = np.take_along_axis(ranks[open_rows], source, axis=1)
            becomes[open_rows] = np.take_along_axis(becomes[open_rows], source, axis=1)
            length[open_rows] -= 1
            for place in (at - 1, at):
                there = (place >= 0) & (place < length[open_rows] - 1)
                rows, place = open_rows[there], place[there]
                ranks[rows, place], becomes[rows, place] = self._look_up(parts[rows, place], parts[rows, place + 1])
            ranks[open_rows, length[open_rows] - 1] = NONE
        data = parts.astype("<u4")
        return [row[:k].tobytes() for row, k in zip(data, length.tolist())]

    def forget(self) -> None:
        """Drop the ids of words and pieces; the vocabulary stays."""
        self.words, self.pieces_between = {}, {}

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words among these that are not known yet."""
        short: defaultdict[int, list[tuple[str, bytes]]] = defaultdict(list)
        if len(self.words) > KEPT_PIECES:
            self.words.clear()
        for word in set(words).difference(self.words):
            data = word.encode()
            if len(data) > SHORT:
                self.words[word] = np.array(self._long([self.bytes[b] for b in data]), dtype="<u4").tobytes()
            else:
                short[(len(data) - 1).bit_length()].append((word, data))
        for group in short.values():
            for start in range(0, len(group), 20_000):
                part = group[start : start + 20_000]
                self.words.update(zip((w for w, _ in part), self._short([d for _, d in part])))

    def _long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < n and (found := self.merges.get((ids[at], ids[after[at]]))):
                heapq.heappush(heap, (found[0], at, ids[at], ids[after[at]], found[1]))

        for at in range(n - 1):
            offer(at)
        while heap:
            _, at, left, right, merged = heapq.heappop(heap)
            if ids[at] != left or after[at] >= n or ids[after[at]] != right:
                continue
            gone = after[at]
            ids[at], ids[gone] = merged, -1
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            offer(at)
            offer(before[at])
        return [i for i in ids if i >= 0]

    def _segments(self, text: str) -> list[str | int]:
        """The text cut at added tokens, which become ids."""
        if not self.specials or not self.specials.search(text):
            return [text]
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += [text[at : found.start()], self.added[found[0]]]
            at = found.end()
        return [*out, text[at:]]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if len(self.pieces_between) > KEPT_PIECES:
            self.pieces_between.clear()
        cut = [[x if isinstance(x, int) else x.split(" ") for x in self._segments(text)] for text in texts]
        fresh = set().union(*(x for segments in cut for x in segments if not isinstance(x, int)))
        fresh.difference_update(self.pieces_between)
        # a piece with white space at an end shares it with its neighbours: such texts are split into words as a whole
        edgy = {p for p in fresh if p != p.strip() or not p}
        fresh -= edgy
        split = self.pattern.findall
        inside = {p: split(" " + p) for p in fresh}
        wanted = set(chain.from_iterable(inside.values()))
        whole: list[list[list[str] | None]] = []
        for segments in cut:
            words = []
            for x in segments:
                if isinstance(x, int):
                    words.append(None)
                elif edgy.isdisjoint(x[1:]):
                    words.append(split(x[0]))
                else:
                    words.append(split(" ".join(x)))
                    x[1:] = []
                wanted.update(words[-1] or ())
            whole.append(words)
        self.learn(wanted)
        ids, between = self.words.__getitem__, self.pieces_between.__getitem__
        self.pieces_between.update((p, b"".join(map(ids, found))) for p, found in inside.items())
        out = []
        for segments, words in zip(cut, whole):
            parts: list[bytes] = []
            for x, first in zip(segments, words):
                if isinstance(x, int):
                    parts.append(x.to_bytes(4, "little"))
                else:
                    parts += map(ids, first)
                    parts += map(between, x[1:])
            out.append(b"".join(parts))
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of the tokens' bytes, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _encoder(content: str) -> Encoder:
    return Encoder(content)


def _digests(batches: Iterator[pa.RecordBatch], vocabulary: Broadcast, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary.value)
    try:
        yield from _digests_of(encoder, batches, with_ids)
    finally:
        encoder.forget()


def _digests_of(encoder: Encoder, batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(1)):
            everything = data.tobytes()
            bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist())
            encoded = encoder.encode_all([everything[a:b].decode("utf-8", "replace") for a, b in bounds])
            counts = [len(x) // 4 for x in encoded]
            ids_sha = [hashlib.sha256(x).hexdigest() for x in encoded]
            numbers = [np.frombuffer(x, dtype="<u4") for x in encoded]
            text_sha = [hashlib.sha256(encoder.decode(x.tolist()).encode()).hexdigest() for x in numbers]
            kept = [pa.array(x.astype(np.int32)) for x in numbers] if with_ids else []
            arrays = [batch.column(0).slice(first, end - first), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum([len(x) for x in kept]))).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(kept)))
                names.append("ids")
            arrays += [batch.column(i).slice(first, end - first) for i in range(2, batch.num_columns)]
            names += batch.schema.names[2:]
            yield pa.RecordBatch.from_arrays(arrays, names)


def encode_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str | None = None,
    with_ids: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: its id, token count, digests of the ids and of the decoded text, and the ids if wanted.

    ``vocabulary`` is the place of a byte-level tokenizer file on the driver, by default the public one of
    50,257 tokens; its content is broadcast, and does not grow with the data. A null text is empty: no tokens.
    Text that spells an added token becomes that token. Rows that repeat are encoded each; the columns ``keep``
    come last, others of ``docs`` are not read.
    """
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"), *(F.col(c) for c in keep or []))
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {OUT}" + ", ids array<int>" * with_ids + "".join(f", `{c}` {kind}" for c, kind in rows.dtypes[2:])
    return rows.mapInArrow(lambda batches: _digests(batches, content, with_ids), schema)
