"""Language-model scoring: prediction by partial matching over bytes, and a unigram baseline over words.

The model is a trie of byte contexts up to ORDER bytes long, with counts from all training texts. A symbol that the
longest known context has not seen is escaped to the next shorter one with PPM's method C, and what the longer
context has seen is excluded there. Every gram of the training texts is kept, however rare.

Neither grams nor word counts are ever in one place: a block of texts asks for the counts of its distinct words and
for the probabilities of its distinct grams. Grams are dealt by the last SUFFIX symbols of their context, so that a part has
all longer contexts with that ending; only the counts of single symbols and pairs, which the alphabet bounds, are
sent to all executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.langid import held_out
from stratalake.llm.textbytes import U64, mix, slices, sums_by, utf8, word_hashes
from stratalake.sources.storage import stored

ORDER = 4
#: Symbols at the end of a context that say which part of the model has it.
SUFFIX = 2
#: Symbols are bytes, the end of a text, and, only in contexts, what is before its beginning.
END, START = 256, 257
SYMBOLS = 257
_BITS = 9
_BLOCK_BYTES = 8_000_000


def symbol_grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(codes, offsets): each symbol of each text with the `order` symbols before it; the text's end is its last symbol."""
    n_docs = len(offsets) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    line = np.full(len(data) + n_docs * (order + 1), START, np.int64)
    line[np.arange(len(data)) + doc * (order + 1) + order] = data
    line[offsets[1:] + np.arange(n_docs) * (order + 1) + order] = END
    code = np.zeros(max(0, len(line) - order), np.int64)
    for k in range(order + 1):
        code = (code << _BITS) | line[k : len(line) - order + k]
    return code[line[order:] != START], offsets + np.arange(n_docs + 1)


@dataclass(frozen=True)
class Trie:
    """Per order, sorted: grams (context and symbol) with counts; contexts with their total, their number of symbols, and
    the total that the next shorter context has of these symbols."""

    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    distinct: list[np.ndarray]
    shadows: list[np.ndarray]

    @classmethod
    def build(cls, tables: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
        """From (gram, count) for each order, 0 first."""
        fields: tuple[list, ...] = ([], [], [], [], [], [])
        for order, (gram, count) in enumerate(tables):
            at = np.argsort(gram)
            gram, count = gram[at], count[at].astype(np.float64)
            context, first = np.unique(gram >> _BITS, return_index=True)
            ends = np.append(first, len(gram))
            shadow = np.zeros(len(gram))
            if order:
                below = gram & ((1 << _BITS * order) - 1)
                shadow = fields[1][order - 1][np.searchsorted(fields[0][order - 1], below)]
            for field, value in zip(fields, (gram, count, context, sums_by(count, ends), np.diff(ends), sums_by(shadow, ends))):
                field.append(value)
        return cls(*fields)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of each code's last symbol after the symbols before it."""
        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        seen_n, seen_q = np.zeros(len(codes)), np.zeros(len(codes))
        for order in range(len(self.grams) - 1, -1, -1):
            gram = codes[open_] & ((1 << _BITS * (order + 1)) - 1)
            at, known = _find(self.contexts[order], gram >> _BITS)
            total = np.where(known, self.totals[order][at] - seen_n[open_], 0) if len(at) else np.zeros(len(open_))
            fresh = np.where(known, self.distinct[order][at] - seen_q[open_], 0) if len(at) else np.zeros(len(open_))
            place, hit = _find(self.grams[order], gram)
            rows = open_[hit]
            out[rows] += np.log10(self.counts[order][place[hit]] / (total[hit] + fresh[hit]))
            miss = ~hit & (fresh > 0)
            out[open_[miss]] += np.log10(fresh[miss] / (total[miss] + fresh[miss]))
            down = ~hit & known
            seen_n[open_[down]] = self.shadows[order][at[down]]
            seen_q[open_[down]] = self.distinct[order][at[down]]
            open_ = open_[~hit]
        out[open_] -= np.log10(np.maximum(1, SYMBOLS - seen_q[open_]))
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


_BLOCKS = pa.schema(
    [
        ("block", pa.int64()),
        ("gram", pa.int64()),
        ("n", pa.int64()),
        ("doc_id", pa.binary()),
        ("valid", pa.binary()),
        ("held_out", pa.binary()),
        ("sizes", pa.binary()),
        ("texts", pa.binary()),
    ]
)
_BLOCKS_SQL = "block bigint, gram bigint, n bigint, doc_id binary, valid binary, held_out binary, sizes binary, texts binary"


def _gather(low: int):
    """A row per block of texts; at a task's end, rows of how often its training texts have each run of `low` symbols."""

    def run(batches):
        task, blocks = TaskContext.get(), 0
        counts = np.zeros(1 << _BITS * low, np.int64)
        for batch in batches:
            ids, out = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            data, offsets = utf8(batch.column(2))
            for i, j in slices(offsets, _BLOCK_BYTES):
                for a, b in slices(offsets[i : j + 1]):
                    a, b = a + i, b + i
                    code, upto = symbol_grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], low - 1)
                    counts += np.bincount(code[np.repeat(~out[a:b], np.diff(upto))], minlength=len(counts))
                texts = pa.compress(data[offsets[i] : offsets[j]].tobytes(), "zstd", asbytes=True)
                row = [
                    task.partitionId() << 32 | blocks, None, None, ids[i:j].tobytes(), valid[i:j].tobytes(), out[i:j].tobytes(),
                    np.diff(offsets[i : j + 1]).tobytes(), texts,
                ]
                blocks += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCKS)], schema=_BLOCKS)
        gram = np.flatnonzero(counts)
        if len(gram):
            blank = {f.name: pa.nulls(len(gram), f.type) for f in _BLOCKS} | {"gram": pa.array(gram), "n": pa.array(counts[gram])}
            yield pa.RecordBatch.from_arrays([blank[f.name] for f in _BLOCKS], schema=_BLOCKS)

    return run


def _texts(sizes: pa.Scalar, texts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a block."""
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(sizes.as_buffer(), np.int64))])
    data = pa.decompress(texts.as_buffer(), int(offsets[-1]), "zstd") if offsets[-1] else b""
    return np.frombuffer(data, np.uint8), offsets


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's words as places in its sorted distinct hashes, their documents, and the hashes."""
    hashes, doc = [], []
    for a, b in slices(offsets):
        h, d = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        hashes.append(h)
        doc.append(d + a)
    number, distinct = pd.factorize(np.concatenate(hashes))
    rank = np.argsort(distinct)
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    return place[number], np.concatenate(doc), distinct[rank]


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, end, symbols, bounds, grams) of each slice of a block: its symbols as places in its distinct grams."""
    out = []
    for a, b in slices(offsets):
        code, at = symbol_grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], order)
        number, distinct = pd.factorize(code)
        out.append((a, b, number.astype(np.int32), at, distinct))
    return out


def _part(grams: np.ndarray, low: int, parts: int) -> np.ndarray:
    suffix = (grams >> _BITS) & ((1 << _BITS * low) - 1)
    return ((mix(suffix.astype(U64)) >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all highest bytes together, which shuffles compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _from_planes(raw: pa.Scalar, kind: type) -> np.ndarray:
    planes = np.frombuffer(raw.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _asked(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    part, block, keys, counts = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(block, pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
        names=["part", "block", "keys", "counts"],
    )


def _ask_words(parts: int):
    """A block's distinct words with their training counts, dealt by hash range."""

    def run(batches):
        for batch in batches:
            for block, held, sizes, texts in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                out = np.frombuffer(held.as_buffer(), bool)
                number, doc, h = _words(*_texts(sizes, texts))
                c = np.bincount(number, ~out[doc], minlength=len(h)).astype(np.uint32)
                part = ((h >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
                cuts = np.searchsorted(part, np.arange(parts + 1))
                rows = [(p, block, h[a:b].tobytes(), c[a:b].tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                if rows:
                    yield _asked(rows)

    return run


def _ask_grams(order: int, low: int, parts: int):
    """A block's distinct grams with their training counts, dealt by the ends of their contexts."""

    def run(batches):
        for batch in batches:
            for block, held, sizes, texts in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                out = np.frombuffer(held.as_buffer(), bool)
                grams, counts = [], []
                for a, b, number, at, distinct in _grams(*_texts(sizes, texts), order):
                    grams.append(distinct)
                    counts.append(np.bincount(number, np.repeat(~out[a:b], np.diff(at)), minlength=len(distinct)))
                gram, place = np.unique(np.concatenate(grams), return_inverse=True)
                count = np.bincount(place, np.concatenate(counts)).astype(np.uint32)
                part = _part(gram, low, parts)
                by = np.argsort(part, kind="stable")
                gram, count = gram[by], count[by]
                cuts = np.searchsorted(part[by], np.arange(parts + 1))
                yield _asked(
                    [
                        (p, block, _planes(np.diff(gram[a:b], prepend=0)), _planes(count[a:b]))
                        for p, (a, b) in enumerate(zip(cuts, cuts[1:]))
                        if b > a
                    ]
                )

    return run


def _answer_words(batches):
    """Corpus counts for what each block asked; a row without a block tells how many words and tokens there are."""
    asked, h, c = [], [], []
    for batch in batches:
        for part, block, hashes, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
            h.append(np.frombuffer(hashes.as_buffer(), U64))
            c.append(np.frombuffer(counts.as_buffer(), np.uint32))
            asked.append((block, part, len(h[-1])))
    if not asked:
        return
    code, distinct = pd.factorize(np.concatenate(h))
    total = np.bincount(code, np.concatenate(c).astype(np.float64), minlength=len(distinct))
    mine = total[code]
    ends = np.cumsum([n for _, _, n in asked])
    rows = [(b, p, mine[e - n : e].astype(np.int64).tobytes(), None, None) for (b, p, n), e in zip(asked, ends)]
    rows.append((None, None, None, int((total > 0).sum()), int(total.sum())))
    types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    for k in range(0, len(rows), 500):
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows[k : k + 500]), types)], names=["block", "part", "found", "distinct", "tokens"]
        )


def _answer_grams(shorter, order: int, low: int):
    """log10 of the probabilities of what each block asked. `shorter` has the grams and counts of the orders below `low`."""

    def run(batches):
        asked, grams, counts = [], [], []
        for batch in batches:
            for part, block, g, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                grams.append(np.cumsum(_from_planes(g, np.int64)))
                counts.append(_from_planes(c, np.uint32))
                asked.append((block, part, len(grams[-1])))
        if not asked:
            return
        gram, place = np.unique(np.concatenate(grams), return_inverse=True)
        count = np.bincount(place, np.concatenate(counts).astype(np.float64)).astype(np.int64)
        del grams, counts
        tables, seen = list(shorter.value), count > 0
        for k in range(low, order + 1):
            some, at = np.unique(gram[seen] & ((1 << _BITS * (k + 1)) - 1), return_inverse=True)
            tables.append((some, np.bincount(at, count[seen], minlength=len(some)).astype(np.int64)))
        found = Trie.build(tables).log10(gram)
        end = 0
        for block, part, n in asked:
            mine, end = found[place[end : end + n]], end + n
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([mine.tobytes()], pa.binary())],
                names=["block", "part", "found"],
            )

    return run


def _score(ends: int, order: int, low: int, parts: int):
    """Per text: tokens, known ones, the sum of log10(count + 0.5), and the score. `ends` is the count of the end token."""

    def read(found: pa.Scalar, kind: type) -> np.ndarray:
        rows = sorted(found.as_py() or [], key=lambda x: x["part"])
        return np.concatenate([np.frombuffer(x["found"], kind) for x in rows]) if rows else np.zeros(0, kind)

    def run(batches):
        for batch in batches:
            for ids, valid, held, sizes, texts, words, grams in zip(*batch.columns):
                ids, out = np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(held.as_buffer(), bool)
                data, offsets = _texts(sizes, texts)
                count, (number, doc, _) = read(words, np.int64), _words(data, offsets)
                at = np.searchsorted(doc, np.arange(len(ids) + 1))
                sums = sums_by(np.log10(count + 0.5)[number], at) + np.log10(ends + 0.5)
                known = sums_by((count > 0).astype(np.int64)[number], at) + (ends > 0)
                # The answers are in the order in which the block asked.
                parted = _grams(data, offsets, order)
                distinct = np.unique(np.concatenate([x[-1] for x in parted]))
                value = np.empty(len(distinct))
                value[np.argsort(_part(distinct, low, parts), kind="stable")] = read(grams, np.float64)
                score = [sums_by(value[np.searchsorted(distinct, g)][symbol], at) for _, _, symbol, at, g in parted]
                columns = [pa.array(ids, mask=~np.frombuffer(valid.as_buffer(), bool)), out, np.diff(at) + 1, known, sums, np.concatenate(score)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns], names=["doc_id", "held_out", "n_tokens", "n_known", "total", "score"]
                )

    return run


def score_texts(docs: DataFrame, left_out: Column | None = None, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of (doc_id, text).

    Both models learn from the rows where `left_out` is false. `score` is log10 of the PPM probability of the text's bytes
    and its end. base_score: words, lower-cased in A-Z, and one end per text, with add-half smoothing over the
    training tokens. Null texts are empty: just an end. Repeated rows count and come each, and so do rows with a null
    doc_id. An empty table gives an empty result; without training rows all symbols are equally likely, and the base counts
    are zero.
    """
    spark = docs.sparkSession
    reducers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = max(1, min(SUFFIX, order))
    out = F.coalesce(left_out if left_out is not None else held_out(of=5, remainder=1), F.lit(False))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), out.alias("held_out"), text.alias("text"))

    gathered = stored(rows.mapInArrow(_gather(low), _BLOCKS_SQL), "scoring")
    blocks = gathered.filter("block IS NOT NULL")
    table = gathered.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()  # at most 257 * 258
    runs, n = table["gram"].to_numpy(np.int64), table["n"].to_numpy(np.int64)
    ends = int(n[runs & ((1 << _BITS) - 1) == END].sum())
    tables = []
    for k in range(low):  # shorter grams are the sums of longer ones, as every text starts with the same context
        some, at = np.unique(runs & ((1 << _BITS * (k + 1)) - 1), return_inverse=True)
        tables.append((some, np.bincount(at, n, minlength=len(some)).astype(np.int64)))

    asked = blocks.select("block", "held_out", "sizes", "texts")
    ask_sql, answer_sql = "part int, block bigint, keys binary, counts binary", "block bigint, part int, found binary"
    words = asked.mapInArrow(_ask_words(reducers), ask_sql).repartition(reducers, "part")
    words = stored(words.mapInArrow(_answer_words, f"{answer_sql}, distinct bigint, tokens bigint"), "word-counts")
    told = words.agg(F.sum("distinct"), F.sum("tokens")).first()
    n_words, tokens = (told[0] or 0) + (ends > 0), (told[1] or 0) + ends

    grams = asked.mapInArrow(_ask_grams(order, low, reducers), ask_sql).repartition(reducers, "part")
    grams = grams.mapInArrow(_answer_grams(spark.sparkContext.broadcast(tables), order, low), answer_sql)

    def per_block(answers: DataFrame, name: str) -> DataFrame:
        return answers.groupBy("block").agg(F.collect_list(F.struct("part", "found")).alias(name))

    whole = blocks.join(per_block(words.filter("block IS NOT NULL"), "words"), "block", "left").join(per_block(grams, "grams"), "block")
    scored = whole.select("doc_id", "valid", "held_out", "sizes", "texts", "words", "grams").mapInArrow(
        _score(ends, order, low, reducers),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, total double, score double",
    )
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("total") - F.col("n_tokens") * F.lit(float(np.log10(tokens + 0.5 * (n_words + 1))))).alias("base_score"),
        "score",
    )
