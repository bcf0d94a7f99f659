"""Language identification with character models of words, one per language.

Each language has an interpolated Kneser-Ney model of the characters of its words: ``ORDER`` characters, a mark for
the start and one for the end of a word. All models lie in the same sorted arrays of n-gram hashes, with one column
of probabilities per language, so one search serves every language. A document goes to the language with the least
cross-entropy per character; above a limit found on documents that were not counted it is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.arrays import mix, slices

ORDER = 4
#: The classifier is fitted on about so many labelled documents of a language, none longer than so many characters.
SAMPLE_DOCUMENTS = 1500
SAMPLE_CHARS = 20_000
MARGIN = 1.5
SHORT_SYMBOLS = 50
KEPT_WORDS = 1 << 18
UNKNOWN = "und"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_START, _END = 1, 2
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    """Lower-case words: a letter, then letters and marks."""
    return _WORD.findall(text.lower())


def gram_hashes(words: list[str], order: int = ORDER) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each predicted character of the words the hashes of the grams that end with it.

    Returns, per order, the hashes of grams (0 where the word has not enough characters before) and those of
    their contexts, and for each character the number of its word. The marks around a word count as characters; the
    first one is never predicted.
    """
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(words) else 0
    symbols = np.empty(total, dtype=np.uint64)
    inner = np.ones(total, dtype=bool)
    inner[ends - lengths] = inner[ends - 1] = False
    symbols[ends - lengths], symbols[ends - 1] = _START, _END
    symbols[inner] = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    place = np.arange(total) - np.repeat(ends - lengths, lengths)
    predicted = np.flatnonzero(place > 0)
    grams, contexts, before = [], [], np.zeros(total, dtype=np.uint64)
    for n in range(1, order + 1):
        enough = place >= n - 1
        current = np.where(enough, mix(before * _ODD + symbols + np.uint64(n)), np.uint64(0))
        grams.append(current[predicted])
        contexts.append(np.where(enough, before, np.uint64(0))[predicted])
        before = np.concatenate((np.zeros(1, np.uint64), current[:-1]))
    return grams, contexts, np.repeat(np.arange(len(words)), lengths - 1)


@dataclass(frozen=True, eq=False)
class LanguageModel:
    """Per order: sorted gram hashes and a column of probabilities per language; sorted context hashes and what they give to the lower order."""

    names: tuple[str, ...]
    keys: tuple[np.ndarray, ...]
    probabilities: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    weights: tuple[np.ndarray, ...]
    unseen: np.ndarray
    limits: tuple[float, ...] = ()

    def _probability(self, n: int, grams: list[np.ndarray], contexts: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        """Of the characters ``rows``, with grams of ``n`` characters."""
        if n == 0:
            return np.broadcast_to(self.unseen, (len(rows), len(self.names)))
        keys, wanted = self.keys[n - 1], grams[n - 1][rows]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[at] == wanted
        out = self.probabilities[n - 1][at]
        missing = np.flatnonzero(~found)
        if len(missing):
            known, context = self.contexts[n - 1], contexts[n - 1][rows[missing]]
            place = np.minimum(np.searchsorted(known, context), len(known) - 1)
            weight = np.where((known[place] == context)[:, None], self.weights[n - 1][place], 1.0)
            out[missing] = weight * self._probability(n - 1, grams, contexts, rows[missing])
        return out

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed negative log-probabilities of each word per language, and its number of predicted characters."""
        grams, contexts, owner = gram_hashes(words, len(self.keys))
        out = np.empty((len(owner), len(self.names)))
        depth = np.sum([g != 0 for g in grams], axis=0)
        for n in range(1, len(self.keys) + 1):
            rows = np.flatnonzero(depth == n)
            if len(rows):
                out[rows] = self._probability(n, grams, contexts, rows)
        first = np.searchsorted(owner, np.arange(len(words)))
        return np.add.reduceat(-np.log(out), first, axis=0), np.bincount(owner, minlength=len(words))


def fit_model(counts: dict[str, dict[str, int]], order: int = ORDER) -> LanguageModel | None:
    """Interpolated Kneser-Ney models from word counts per language.

    Full counts at the highest order and for grams at the start of a word, numbers of different left
    neighbours else; one discount per order, n1 / (n1 + 2 n2).
    """
    names = tuple(sorted(name for name, words in counts.items() if words))
    if not names:
        return None
    raw = []  # per language and order: grams, contexts, suffixes, at a start, counts
    for name in names:
        words = list(counts[name])
        often = np.fromiter((counts[name][w] for w in words), dtype=np.float64, count=len(words))
        grams, contexts, owner = gram_hashes(words, order)
        weight = often[owner]
        levels = []
        for n in range(order):
            have = grams[n] != 0
            keys, first, inverse = np.unique(grams[n][have], return_index=True, return_inverse=True)
            total = np.bincount(inverse, weights=weight[have], minlength=len(keys))
            suffix = grams[n - 1][have][first] if n else np.zeros(len(keys), np.uint64)
            longer = grams[n + 1][have][first] != 0 if n + 1 < order else np.zeros(len(keys), bool)
            levels.append([keys, contexts[n][have][first], suffix, ~longer, total])
        for n in range(order - 1):  # numbers of left neighbours
            keys, _, _, at_start, total = levels[n]
            at = np.searchsorted(keys, levels[n + 1][2])
            left = np.bincount(at, minlength=len(keys)).astype(np.float64)
            levels[n][4] = np.where(at_start, total, np.maximum(left, 1))
        raw.append(levels)
    alphabet = len(np.unique(np.concatenate([levels[0][0] for levels in raw])))
    unseen = np.full(len(names), 1.0 / (alphabet + 1))
    keys_all, prob_all, context_all, weight_all = [], [], [], []
    for n in range(order):
        keys, first = np.unique(np.concatenate([levels[n][0] for levels in raw]), return_index=True)
        context = np.concatenate([levels[n][1] for levels in raw])[first]
        suffix = np.concatenate([levels[n][2] for levels in raw])[first]
        contexts, in_context = np.unique(context, return_inverse=True)
        if n:
            lower = prob_all[-1][np.searchsorted(keys_all[-1], suffix)]
        else:
            lower = np.broadcast_to(unseen, (len(keys), len(names)))
        prob, weight = np.empty((len(keys), len(names))), np.empty((len(contexts), len(names)))
        for g, levels in enumerate(raw):
            count = np.zeros(len(keys))
            count[np.searchsorted(keys, levels[n][0])] = levels[n][4]
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            total = np.bincount(in_context, weights=count, minlength=len(contexts))
            kinds = np.bincount(in_context, weights=count > 0, minlength=len(contexts))
            seen = total > 0
            weight[:, g] = np.where(seen, discount * kinds / np.where(seen, total, 1), 1.0)
            share = np.maximum(count - discount, 0) / np.where(seen, total, 1)[in_context]
            prob[:, g] = share + weight[in_context, g] * lower[:, g]
        keys_all.append(keys)
        prob_all.append(prob)
        context_all.append(contexts)
        weight_all.append(weight)
    return LanguageModel(names, tuple(keys_all), tuple(prob_all), tuple(context_all), tuple(weight_all), unseen)


class Scorer:
    """Cross-entropies of texts; scores of words met before are kept, up to a bound."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sums = np.zeros((0, len(self.model.names)))
        self.sizes = np.zeros(0)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: cross-entropy per character and language (nan without a letter), and characters counted."""
        if len(self.known) > KEPT_WORDS:
            self._forget()
        found = [words_of(text) for text in texts]
        fresh = list(set().union(*found).difference(self.known))
        if fresh:
            sums, sizes = self.model.score_words(fresh)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.sums, self.sizes = np.concatenate((self.sums, sums)), np.concatenate((self.sizes, sizes))
        entropy = np.full((len(texts), len(self.model.names)), np.nan)
        symbols = np.zeros(len(texts))
        for i, words in enumerate(found):
            if words:
                at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
                symbols[i] = self.sizes[at].sum()
                entropy[i] = self.sums[at].sum(axis=0) / symbols[i]
        return entropy, symbols


def _decisions(entropy: np.ndarray, symbols: np.ndarray, model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    lettered = symbols > 0
    safe = np.where(lettered[:, None], entropy, 0.0)
    best = safe.argmin(axis=1)
    least = safe[np.arange(len(safe)), best]
    rivals = np.exp(-(safe - least[:, None]) * np.minimum(symbols, SHORT_SYMBOLS)[:, None])
    score = np.where(lettered, 1.0 / rivals.sum(axis=1), 0.0)
    limits = np.array(model.limits) if model.limits else np.full(len(model.names), np.inf)
    rejected = ~lettered | ((least > limits[best]) & (symbols >= SHORT_SYMBOLS))
    names = [model.names[b] if has else UNKNOWN for b, has in zip(best, lettered)]
    return names, score, np.where(lettered, least, np.nan), rejected


OUT = "lang_pred string, score double, entropy double, rejected boolean"


def _predict(batches: Iterator[pa.RecordBatch], model: Broadcast, columns: int, text: int) -> Iterator[pa.RecordBatch]:
    """Predictions beside the first ``columns`` columns; column number ``text`` is the text."""
    scorer = Scorer(model.value) if model.value is not None else None
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(text), 1 << 20):
            everything = data.tobytes()
            bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist())
            texts = [everything[a:b].decode("utf-8", "replace") for a, b in bounds]
            if scorer is None:
                lettered = [bool(words_of(text)) for text in texts]
                results = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts), [not x for x in lettered]
            else:
                results = _decisions(*scorer(texts), model.value)
            kinds = pa.string(), pa.float64(), pa.float64(), pa.bool_()
            arrays = [batch.column(i).slice(first, end - first) for i in range(columns)]
            arrays += [pa.array(r, kind, from_pandas=True) for r, kind in zip(results, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(columns)] + ["lang_pred", "score", "entropy", "rejected"])


def held_out(id_column: str):
    """Whether a document is kept out of learning: crc32 of its id as text leaves 2 modulo 4. Null ids are not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.setdefault(name, Counter()).update(words_of(text))
        rows = [(name, word, n) for name, words in counts.items() for word, n in words.items()]
        if rows:
            names, words, numbers = zip(*rows)
            yield pa.RecordBatch.from_pydict({"lang": names, "word": words, "n": pa.array(numbers, pa.int64())})


def train(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_chars: int = SAMPLE_CHARS,
) -> LanguageModel | None:
    """Fit on a bounded sample of labelled documents that are not held out; None if there are none.

    Of each language about ``sample_documents`` documents are taken, by a hash of id and text, and of each its first
    ``sample_chars`` characters. Rows that repeat id and text count once. The remainder 3 of crc32 modulo 4 is not counted but sets the limits of rejection: the largest
    cross-entropy met there in a language plus ``MARGIN``. Word counts of the sample, bounded by it, are gathered on the driver.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"), held_out(id_column).alias("held_out")
    ).where("not held_out and lang is not null and text is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    spread = 1 << 32
    luck = F.pmod(F.xxhash64("id", "text"), F.lit(spread))
    shares = F.create_map(*(x for name, n in sizes.items() for x in (F.lit(name), F.lit(int(spread * min(1, sample_documents / n))))))
    sample = rows.where(luck < shares[F.col("lang")]).select("id", F.substring("text", 1, sample_chars).alias("text"), "lang").distinct()
    calibrates = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 3, F.lit(False))
    found = (
        sample.where(~calibrates).select("lang", "text").mapInArrow(_count_words, "lang string, word string, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    )
    counts: dict[str, dict[str, int]] = {}
    for name, word, n in zip(*(found.column(c).to_pylist() for c in ("lang", "word", "n"))):
        counts.setdefault(name, {})[word] = n
    model = fit_model(counts)
    if model is None:
        return None
    checked = predict(sample.where(calibrates), model, ["lang"], "text").where("lang = lang_pred")
    worst = {r.lang: r.worst for r in checked.groupBy("lang").agg(F.max("entropy").alias("worst")).collect()}
    return replace(model, limits=tuple(worst[name] + MARGIN if name in worst else float("inf") for name in model.names))


def predict(docs: DataFrame, model: LanguageModel | None, keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns ``keep`` and lang_pred, score, entropy and rejected, for every row.

    Without a letter the language is ``und``, the score 0 and the row is rejected. Without a model every row is ``und``, and
    those with a letter are not rejected.
    """
    kinds = {f.name: f.dataType for f in docs.select(*(F.col(f"`{c}`") for c in keep)).schema}
    value = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    width, text = len(keep), keep.index(text_column) if text_column in keep else len(keep)
    if text == width:  # else it is there already, and is not sent twice
        columns.append(F.col(f"`{text_column}`").cast("binary").alias("body"))
    schema = ", ".join([*(f"c{i} {kinds[c].simpleString()}" for i, c in enumerate(keep)), OUT])
    found = docs.select(columns).mapInArrow(lambda batches: _predict(batches, value, width, text), schema)
    return found.withColumnsRenamed({f"c{i}": c for i, c in enumerate(keep)})


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, entropy per character, and whether it is rejected.

    Learned from the labelled documents of ``docs`` itself that are not held out. Null and empty texts have no letter. Rows
    that repeat are judged each; other columns of ``docs`` are not read.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    )
    return predict(rows, train(rows, "doc_id", "text", "lang"), ["doc_id", "held_out"])


def accepted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected."""
    columns = docs.columns
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    place = {c: f"c{columns.index(c)}" for c in (id_column, text_column, lang_column)}
    model = train(rows, place[id_column], place[text_column], place[lang_column])
    found = predict(rows, model, rows.columns, place[text_column]).where("not rejected")
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
