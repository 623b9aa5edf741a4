"""Ranked lexical search by dense blocked matrix products.

The terms of a block of items are a compact vocabulary. One pass over the documents keeps, for each, how often it holds
each of these terms, as a short sparse vector. Tiles of items by terms (weights) times tiles of terms by documents
(impacts) are then dense float64 products. Weights and impacts are whole numbers, and a tile is never wider than 2^53
divided by the largest product, so every partial sum is exact whatever order it is taken in; tiles are added as integers.
Each task keeps the best documents of each item with all ties at the edge settled by id.

Documents: a row is a document, also where ids or texts repeat. A null or term-less text counts nowhere and is never
found; a null doc_id ranks behind all ids of the same score. Rows that share an item_id (null too) are one item with the
terms of all; an item whose terms no document holds has no row. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.textbytes import LOWER, segment_hashes, slices, utf8, word_bounds
from stratalake.sources.storage import stored

K = 50
#: Items are read in blocks of at most this many bytes of terms (one item may be larger); a block is what is broadcast.
BLOCK_BYTES = 4_000_000
ITEM_TILE = 256
TERM_TILE = 2048
DOCUMENT_TILE = 1024
#: The first of two rounds of ranking deals an item's rows to this many groups, so that no task gets those of all tasks.
SALTS = 64

#: Bytes of terms: ASCII letters and digits, and all of any other character.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SCALE = 1_000_000_000
_MAX_IMPACT = 1_000_000


def term_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of all terms."""
    return word_bounds(np.where(_TERM[data], data, np.uint8(0x20)), offsets)


def _terms(text: str) -> set[bytes]:
    data = LOWER[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    starts, ends, _ = term_bounds(data, np.array([0, len(data)]))
    whole = data.tobytes()
    return {whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())}


class Vocabulary:
    """Finds which of its terms the words of a byte array are; hits are compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        self.lengths = np.diff(ends, prepend=0)
        self.starts = ends - self.lengths
        for self.which in (0, 1):
            hashes = segment_hashes(self.data, self.starts, ends, self.which)
            self.order = np.argsort(hashes)
            self.hashes = hashes[self.order]
            if (self.hashes[1:] != self.hashes[:-1]).all():
                return
        raise ValueError("two terms collide under both hashes")

    def __len__(self) -> int:
        return len(self.lengths)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which words are terms, their terms)."""
        h = segment_hashes(data, starts, ends, self.which)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        words = np.flatnonzero(self.hashes[at] == h)
        term = self.order[at[words]]
        same = ends[words] - starts[words] == self.lengths[term]
        words, term = words[same], term[same]
        if len(words):
            length = self.lengths[term]
            first = np.cumsum(length) - length
            step = np.arange(length.sum()) - np.repeat(first, length)
            equal = data[np.repeat(starts[words], length) + step] == self.data[np.repeat(self.starts[term], length) + step]
            same = np.logical_and.reduceat(equal, first)
            words, term = words[same], term[same]
        return words, term


def item_blocks(items: DataFrame) -> Iterator[tuple[list[int | None], list[set[bytes]]]]:
    """(ids, terms) of items, block by block."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    ids, terms, size = [], [], 0
    for item, text in rows.filter("text IS NOT NULL").orderBy("item_id").toLocalIterator():
        found = _terms(text)
        if ids and ids[-1] == item:
            size += sum(map(len, found - terms[-1]))
            terms[-1] |= found
            continue
        new = sum(map(len, found))
        if ids and size + new > BLOCK_BYTES:
            yield ids, terms
            ids, terms, size = [], [], 0
        ids.append(item)
        terms.append(found)
        size += new
    if ids:
        yield ids, terms


_VECTORS = "doc_id bigint, n bigint, terms binary, times binary"


def _vectors(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Every document with a term: its id, its number of terms, and which of the vocabulary it has how often."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        vocabulary = held.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets):
                part, at = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
                starts, ends, doc = term_bounds(part, at)
                n = np.bincount(doc, minlength=j - i)
                words, term = vocabulary.find(part, starts, ends)
                pair, times = np.unique(doc[words] * len(vocabulary) + term, return_counts=True)
                row, term = np.divmod(pair, len(vocabulary))
                term, times = term.astype(np.int32), times.astype(np.int32)
                full = np.flatnonzero(n)
                cut = np.searchsorted(row, full), np.searchsorted(row, full, "right")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i).take(pa.array(full)),
                        pa.array(n[full].astype(np.int64)),
                        *(pa.array([x[a:b].tobytes() for a, b in zip(*cut)], pa.binary()) for x in (term, times)),
                    ],
                    names=["doc_id", "n", "terms", "times"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.filter("text IS NOT NULL").mapInArrow(run, _VECTORS)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the vectors of a batch."""
    terms, times = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32) for c in (2, 3))
    sizes = np.fromiter((len(x) // 4 for x in batch.column(2).to_pylist()), np.int64, batch.num_rows)
    return np.repeat(np.arange(batch.num_rows), sizes), terms, times


def _totals(vectors: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents, terms of all documents, documents of each term)."""

    def run(batches):
        found = np.zeros(size + 2, np.int64)
        for batch in batches:
            found[:size] += np.bincount(_flat(batch)[1], minlength=size)
            found[size:] += batch.num_rows, batch.column(1).to_numpy().sum()
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["term", "n"])

    counts = vectors.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    whole = np.zeros(size + 2, np.int64)
    whole[counts["term"]] = counts["n"]
    return int(whole[size]), int(whole[size + 1]), whole[:size]


def item_tiles(terms: list[np.ndarray], weights: np.ndarray) -> list[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first item, end, [(terms, weights [term, item]), ...]) for all items; partial sums stay below 2^53."""
    width = max(1, min(TERM_TILE, (2**53 - 1) // (_MAX_IMPACT * max(1, int(weights.max(initial=1))))))
    tiles = []
    for i in range(0, len(terms), ITEM_TILE):
        here = terms[i : i + ITEM_TILE]
        columns = np.unique(np.concatenate(here))
        columns = columns[weights[columns] > 0]
        parts = []
        for k in range(0, len(columns), width):
            part = columns[k : k + width]
            dense = np.zeros((len(part), len(here)))
            for item, mine in enumerate(here):
                at = np.flatnonzero(np.isin(part, mine))
                dense[at, item] = weights[part[at]]
            parts.append((part, dense))
        tiles.append((i, i + len(here), parts))
    return tiles


class Best:
    """The k best (score, id) of each item so far; ties at the edge go to the smaller id, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.zeros(items, np.int64)
        self.rows = tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def add(self, first: int, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        """`scores` is [document, item], for the items from `first` on."""
        edge = np.maximum(self.floor[first : first + scores.shape[1]], 1)
        doc, item = np.nonzero(scores >= edge)
        if not len(doc):
            return
        new = item + first, scores[doc, item], null[doc], ids[doc]
        item, score, none, key = (np.concatenate(x) for x in zip(self.rows, new))
        order = np.lexsort((key, none, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.k]
        self.rows = tuple(x[order] for x in (np.concatenate((self.rows[0], new[0])), score, none, key))
        last = place[place < self.k] == self.k - 1
        self.floor[self.rows[0][last]] = self.rows[1][last]


def _scored(vectors: DataFrame, ids: list[int | None], tiles, size: int, documents: int, terms: int, k: int) -> DataFrame:
    """Each task's best documents of each item."""
    held = vectors.sparkSession.sparkContext.broadcast((ids, tiles))

    def run(batches):
        ids, tiles = held.value
        best = Best(len(ids), k)
        column = np.full(size, -1, np.int64)
        for batch in batches:
            null = np.asarray(batch.column(0).is_null())
            doc_id = batch.column(0).fill_null(0).to_numpy()
            n = batch.column(1).to_numpy()
            row, term, times = _flat(batch)
            if len(n) and int(n.max()) * 50 * documents < 2**63:
                length = 50 + 50 * n * documents // terms
            else:
                length = np.array([50 + 50 * x * documents // terms for x in n.tolist()], np.int64)
            times = times.astype(np.int64)
            impact = (_SCALE * times // (1000 * times + 20 * length[row])).astype(np.float64)
            for i in range(0, batch.num_rows, DOCUMENT_TILE):
                j = min(i + DOCUMENT_TILE, batch.num_rows)
                a, b = np.searchsorted(row, (i, j))
                for first, end, parts in tiles:
                    scores = np.zeros((j - i, end - first), np.int64)
                    for part, dense in parts:
                        column[part] = np.arange(len(part))
                        at = column[term[a:b]]
                        inside = at >= 0
                        block = np.zeros((j - i, len(part)))
                        block[row[a:b][inside] - i, at[inside]] = impact[a:b][inside]
                        scores += (block @ dense).astype(np.int64)
                        column[part] = -1
                    best.add(first, scores, null[i:j], doc_id[i:j])
        item, score, none, key = best.rows
        names = np.array(ids, object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[item].tolist(), pa.int64()), pa.array(key, mask=none), pa.array(score)],
            names=["item_id", "doc_id", "score"],
        )

    return vectors.mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def top_rows(rows: DataFrame, group: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank, in two rounds, so that a group of any size spans many tasks."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    first = F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order))
    some = salted.withColumn(rank, first).filter(F.col(rank) <= k).drop("_salt", rank)
    return some.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col(rank) <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of `docs` (doc_id, text) that rank best for each item.

    `items` is (item_id, text). For each block of items documents are read once.
    """
    spark = docs.sparkSession
    found = None
    for ids, terms in item_blocks(items):
        words = sorted(set().union(*terms))
        if not words:
            continue
        at = {w: i for i, w in enumerate(words)}
        vectors = stored(_vectors(docs, Vocabulary(words)), "term-vectors")
        documents, length, holding = _totals(vectors, len(words))
        weights = np.array([int(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) if n else 0 for n in holding], np.int64)
        tiles = item_tiles([np.array(sorted(at[w] for w in t), np.int64) for t in terms], weights)
        part = _scored(vectors, ids, tiles, len(words), documents, length, k)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    best = top_rows(found, "item_id", [F.desc("score"), F.asc_nulls_last("doc_id")], k)
    return best.select("item_id", "rank", "doc_id", "score")
