"""Language identification with one bit-sliced Bloom filter for all languages.

Slot i of the filter holds a bit for each language. The slots of an n-gram, and-ed together, are the bitmask of all
languages that contain it. A document's distinct n-grams are counted per language by popcount; the filter's own false
positive rate, known from how full each language's slice is, is taken off again; the language with most n-grams wins.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.textbytes import U64, distinct_by_document, mix, sums_by
from stratalake.sources.storage import stored

#: A language contains an n-gram that at least this share of its documents has, and no less than a part of the
#: share in the language that has it most. At most 1 / MIN_SHARE times a document's mean number of n-grams get in,
#: however large the corpus is; that bounds what the driver holds.
MIN_SHARE = 0.002
MAX_RATIO = 10.0
#: Slots for each n-gram and hashes of it.
SLOTS = 12
HASHES = 6
UNDECIDED = "und"

_SLICE_CHARS = 1_000_000
_FLUSH = 2_000_000


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _slices(texts: list[str | None]):
    i = size = 0
    for j, text in enumerate(texts):
        size += len(text or "")
        if size >= _SLICE_CHARS or j == len(texts) - 1:
            yield i, j + 1
            i, size = j + 1, 0


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, offsets): distinct letter trigrams of each text, lower-cased; white space and signs count as word ends."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(_letters()[points], points, 0).astype(U64)
    doc = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 1 for t in lowered), np.int64, len(texts)))
    gram = (code[:-2] << U64(42)) | (code[1:-1] << U64(21)) | code[2:]
    inside = code[1:-1] > 0
    return distinct_by_document(gram[inside], doc[: len(gram)][inside], len(texts))


@dataclass(frozen=True)
class Filter:
    """Bit-sliced Bloom filter: words[w, slot] has a bit for each of the languages 64 w to 64 w + 63."""

    languages: tuple[str, ...]
    words: np.ndarray
    false_rate: np.ndarray
    default: str

    @classmethod
    def build(cls, languages: list[str], grams: np.ndarray, language: np.ndarray, default: str) -> Filter:
        slots = 1 << max(6, int(SLOTS * max(1, len(np.unique(grams))) - 1).bit_length())
        words = np.zeros((max(1, -(-len(languages) // 64)), slots), U64)
        for slot in _slots(grams, slots):
            np.bitwise_or.at(words, (language // 64, slot), U64(1) << (language % 64).astype(U64))
        full = [((words[i // 64] >> U64(i % 64)) & U64(1)).mean() for i in range(len(languages))]
        return cls(tuple(languages), words, np.array(full) ** HASHES, default)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Bitmask words of the languages that contain each n-gram."""
        found = None
        for slot in _slots(grams, self.words.shape[1]):
            here = self.words[:, slot]
            found = here if found is None else found & here
        return found

    def shares(self, grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """[document, language]: the share of its n-grams that the language contains, false positives taken off."""
        masks, n = self.masks(grams), np.maximum(np.diff(offsets), 1)
        out = np.empty((len(offsets) - 1, len(self.languages)))
        for i in range(len(self.languages)):
            hits = sums_by(((masks[i // 64] >> U64(i % 64)) & U64(1)).astype(np.int64), offsets)
            out[:, i] = (hits / n - self.false_rate[i]) / max(1e-9, 1 - self.false_rate[i])
        return np.clip(out, 0, 1)


def _slots(grams: np.ndarray, slots: int):
    h = mix(grams + U64(0x9E3779B97F4A7C15))
    step = mix(h) | U64(1)
    for _ in range(HASHES):
        yield (h & U64(slots - 1)).astype(np.int64)
        h = h + step


def _document_counts(batches):
    """(lang, gram, n): in how many documents of each language an n-gram is; gram -1 counts the documents."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merge(parts):
        grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)

    def flush():
        for lang, parts in held.items():
            grams, counts = merge(parts)
            for k in range(0, len(grams), 100_000):
                part = slice(k, k + 100_000)
                n = len(grams[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array(grams[part].view(np.int64)), pa.array(counts[part])],
                    names=["lang", "gram", "n"],
                )
        held.clear()

    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, j in _slices(texts):
            flat, offsets = ngrams(texts[i:j])
            by_lang = np.array(langs[i:j], object)
            for lang in set(langs[i:j]):
                mine = np.repeat(by_lang == lang, np.diff(offsets))
                grams, counts = np.unique(flat[mine], return_counts=True)
                grams = np.append(grams, np.array([-1], np.int64).view(U64))
                held.setdefault(lang, []).append((grams, np.append(counts, (by_lang == lang).sum())))
                size += len(grams)
        if size > _FLUSH:
            held = {lang: [merge(parts)] for lang, parts in held.items()}
            size = sum(len(p[0][0]) for p in held.values())
            if size > _FLUSH // 2:
                yield from flush()
                size = 0
    yield from flush()


def learn(docs: DataFrame) -> Filter:
    """Fit the filter on all rows of (text, lang) whose lang is not null."""
    texts = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).filter("lang IS NOT NULL")
    counts = texts.mapInArrow(_document_counts, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts, "ngram-counts")
    # A row per language, each of which has a slice of the filter that the driver and every task hold.
    totals = counts.filter("gram = -1").select("lang", F.col("n").alias("docs"))
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("docs"))
    shares = shares.filter(F.col("share") >= MIN_SHARE)
    shares = shares.withColumn("top", F.max("share").over(Window.partitionBy("gram")))
    kept = shares.filter((F.col("gram") == -1) | (F.col("share") * MAX_RATIO >= F.col("top"))).select("lang", "gram", "n").toPandas()
    languages = sorted(kept["lang"].unique())
    docs_of = kept[kept["gram"] == -1].set_index("lang")["n"]
    default = min(languages, key=lambda x: (-docs_of[x], x)) if languages else UNDECIDED
    grams = kept[kept["gram"] != -1]
    index = grams["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    return Filter.build(languages, grams["gram"].to_numpy(np.int64).view(U64), index, default)


def predict(docs: DataFrame, model: Filter, keep: list[str]) -> DataFrame:
    """Columns `keep` of (.., text) with lang_pred and score, the share of n-grams that the language contains.

    A text that is null or has no letter is `und` with score 0. On a tie the first language by name wins; a text with
    letters, none of whose n-grams any language contains, gets the language with most documents. Rows
    may repeat. Without a learned language everything is `und`.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        names = np.array([*model.languages, model.default, UNDECIDED], object)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for i, j in _slices(texts):
                flat, offsets = ngrams(texts[i:j])
                n = len(model.languages)
                if n:
                    shares = model.shares(flat, offsets)
                    best, score = shares.argmax(axis=1), shares.max(axis=1)
                    best[score == 0] = n
                else:
                    best, score = np.full(j - i, n), np.zeros(j - i)
                none = np.diff(offsets) == 0
                best[none], score[none] = n + 1, 0.0
                kept = [batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"]
                )

    picked = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id", of: int = 4, remainder: int = 2) -> Column:
    """Rows that learning leaves out: crc32 of the id as text has this remainder. A row without an id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == remainder, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of all documents, learned from text and lang of those not held out."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    model = learn(docs.filter(~held_out()))
    found = predict(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def accepted(docs: DataFrame, min_score: float) -> DataFrame:
    """Rows of `docs`, with all their columns, whose text has a language: not `und`, score `min_score` or more."""
    model = learn(docs.filter(~held_out()).select("text", "lang"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    found = predict(rows, model, ["row"])
    return found.filter((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= min_score)).select("row.*")
