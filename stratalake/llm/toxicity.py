"""Toxic spans and documents by a linear-chain conditional random field.

A text's terms, in sequences that end with a sentence, are tagged O or T. Only documents are labelled, so token labels
are projected first: in a toxic document a term is T if its word or one of its beginnings stands in toxic documents
significantly more often than in others (log-likelihood ratio against the number of features tried) and mostly there;
all terms of clean documents are O, and toxic documents without any T teach nothing. The field is fitted to these by
stochastic gradients of its exact likelihood. Forward-backward gives each term's probability of T; runs above 0.5 are
the spans; a document's score comes from its highest probability and the number of its T terms, through a logistic
regression on the sample's document labels.

The field is fitted on a bounded sample: at most SAMPLE_TOXIC and SAMPLE_CLEAN labelled documents, by hash of the id, and
of these the ones up to SAMPLE_BYTES long. All documents are scored whole.

A null text is empty; texts without terms score like the cleanest text. A null doc_id is not held out and has no
label; rows may repeat. Of several labels of an id the highest counts, null labels do not. Without a toxic label in the
sample every score is 0, without a clean one 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.ranking import term_bounds
from stratalake.llm.textbytes import LOWER, U64, mix, segment_hashes, slices, utf8

SAMPLE_TOXIC = 1500
SAMPLE_CLEAN = 3000
SAMPLE_BYTES = 8_000
#: A sequence ends at one of these bytes, and after so many terms.
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[[0x0A, 0x21, 0x2E, 0x3F]] = True
LONGEST = 64
FEATURE_BITS = 18
PREFIXES = (3, 4, 5)
SUFFIX = 3
EPOCHS = 6
#: A small sample is gone through more often, until this many steps are made.
STEPS = 120
BATCH = 4096
RATE = 0.3
#: Of the documents that have a telling feature, at least this share is toxic.
PURITY = 0.5

_KINDS = mix(np.arange(1, 16, dtype=U64) * U64(0x9E3779B97F4A7C15))
_OWN = slice(1, 2 + len(PREFIXES))  # the word and its beginnings
_LIMIT = 30.0


@dataclass(frozen=True)
class Sequences:
    """Terms of documents, with their sequences and features [kind, term]."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    length: np.ndarray
    features: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Sequences:
        data = LOWER[data]
        starts, ends, doc = term_bounds(data, offsets)
        n = len(starts)
        stops = np.concatenate([[0], np.cumsum(SENTENCE_END[data], dtype=np.int64)])
        new = np.ones(n, bool)
        new[1:] = (doc[1:] != doc[:-1]) | (stops[starts[1:]] != stops[ends[:-1]])
        place = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
        first = np.flatnonzero(place % LONGEST == 0)
        length = np.diff(np.append(first, n))
        opens = np.zeros(n, bool)
        opens[first] = True
        word = segment_hashes(data, starts, ends)
        before, after = np.zeros(n, U64), np.zeros(n, U64)
        before[1:] = np.where(opens[1:], U64(0), word[:-1])
        after[:-1] = np.where(opens[1:], U64(0), word[1:])
        kinds = [
            np.zeros(n, U64),
            word,
            *(segment_hashes(data, starts, np.minimum(starts + k, ends)) for k in PREFIXES),
            segment_hashes(data, np.maximum(ends - SUFFIX, starts), ends),
            before,
            after,
        ]
        features = np.empty((len(kinds), n), np.int32)
        for i, h in enumerate(kinds):
            features[i] = mix(h + _KINDS[i]) >> U64(64 - FEATURE_BITS)
        return cls(starts, ends, doc, first, length, features)


def odds(emission: np.ndarray, first: np.ndarray, length: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(forward, backward) odds of T against O at every term; their product is the marginal odds.

    `moves` are the scores of starting with T, O to T, T to O and T to T; starting with O and O to O score 0.
    Sequences advance together, a term at a time.
    """
    e = np.exp(np.clip(emission, -_LIMIT, _LIMIT))
    begin, up, down, stay = np.exp(np.clip(moves, -_LIMIT, _LIMIT))
    forward, backward = np.empty(len(e)), np.ones(len(e))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    forward[first] = e[first] * begin
    active = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length.max(initial=0)) + 1)]
    for t in range(1, len(active) - 1):
        at = first[: active[t]] + t
        r = forward[at - 1]
        forward[at] = e[at] * (up + r * stay) / (1 + r * down)
    for t in range(len(active) - 2, 0, -1):
        at = first[: active[t]] + t
        x = e[at] * backward[at]
        backward[at - 1] = (down + stay * x) / (1 + up * x)
    return forward, backward


@dataclass(frozen=True)
class Field:
    """Weights of T by feature, scores of the moves, and the regression from tags to a document's score."""

    weights: np.ndarray
    moves: np.ndarray
    document: np.ndarray

    def marginals(self, s: Sequences) -> np.ndarray:
        emission = np.zeros(len(s.doc))
        for kind in s.features:
            emission += self.weights[kind]
        forward, backward = odds(emission, s.first, s.length, self.moves)
        both = forward * backward
        return both / (1 + both)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.document, -_LIMIT, _LIMIT)))


def evidence(p: np.ndarray, doc: np.ndarray, documents: int) -> np.ndarray:
    """[document, (1, highest log odds of T, logarithm of the number of T terms)]."""
    highest = np.zeros(documents)
    np.maximum.at(highest, doc, p)
    top = np.clip(highest, 1e-6, 1 - 1e-6)
    tagged = np.bincount(doc[p >= 0.5], minlength=documents)
    return np.stack([np.ones(documents), np.log(top / (1 - top)), np.log1p(tagged)], axis=1)


def project(s: Sequences, toxic: np.ndarray) -> np.ndarray:
    """Which terms are T, from which documents are toxic."""
    size = 1 << FEATURE_BITS
    total, bad = len(toxic), int(toxic.sum())
    marked = np.zeros(len(s.doc), bool)
    tried, found = 0, []
    for kind in s.features[_OWN]:
        pairs = np.unique(s.doc * size + kind)
        doc, feature = np.divmod(pairs, size)
        n = np.bincount(feature, minlength=size).astype(float)
        a = np.bincount(feature[toxic[doc]], minlength=size).astype(float)
        tried += int((n > 0).sum())
        found.append((kind, n, a))
    for kind, n, a in found:
        ratio = 0.0
        for seen, expected in ((a, n * bad / total), (n - a, n * (total - bad) / total), (bad - a, bad * (total - n) / total), (total - bad - n + a, (total - bad) * (total - n) / total)):
            ratio = ratio + 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0)
        telling = (ratio >= 2 * np.log(max(tried, 1))) & (a >= PURITY * n) & (a * total > n * bad)
        marked |= telling[kind]
    return marked & toxic[s.doc]


def fit(s: Sequences, tags: np.ndarray, use: np.ndarray, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves that fit `tags` on the sequences `use`, by Adagrad on the exact gradient."""
    size = 1 << FEATURE_BITS
    weights, moves = np.zeros(size), np.zeros(4)
    seen, seen_moves = np.full(size, 1e-3), np.full(4, 1e-3)
    weights[s.features[0][:1]] = -3.0
    rng = np.random.default_rng(seed)
    chosen = np.flatnonzero(use) if tags.any() else np.zeros(0, np.int64)
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(1, len(chosen))))):
        order = rng.permutation(chosen)
        for i in range(0, len(order), BATCH):
            part = np.sort(order[i : i + BATCH])
            length = s.length[part]
            first = np.cumsum(length) - length
            at = np.arange(length.sum()) + np.repeat(s.first[part] - first, length)
            feature, tag = s.features[:, at], tags[at].astype(float)
            emission = weights[feature].sum(axis=0)
            forward, backward = odds(emission, first, length, moves)
            both = forward * backward
            miss = tag - both / (1 + both)
            gradient = np.zeros(size)
            for kind in feature:
                gradient += np.bincount(kind, miss, size)
            inner = np.ones(len(at), bool)
            inner[first] = False
            b = np.flatnonzero(inner)
            a = b - 1
            x = np.exp(np.clip(emission[b], -_LIMIT, _LIMIT)) * backward[b]
            up, down, stay = np.exp(np.clip(moves[1:], -_LIMIT, _LIMIT))
            joint = np.stack([up * x, forward[a] * down, forward[a] * stay * x])
            joint /= 1 + joint.sum(axis=0)
            met = np.stack([(1 - tag[a]) * tag[b], tag[a] * (1 - tag[b]), tag[a] * tag[b]])
            step = np.concatenate([[miss[first].sum()], (met - joint).sum(axis=1)])
            n = len(part)
            gradient = gradient / n - 1e-6 * weights
            step = step / n - 1e-4 * moves
            seen += gradient**2
            seen_moves += step**2
            weights += RATE * gradient / np.sqrt(seen)
            moves += RATE * step / np.sqrt(seen_moves)
    return weights, moves


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients of a logistic regression by Newton's method, kept small."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -_LIMIT, _LIMIT)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def held_out(of: int = 5, remainder: int = 0) -> Column:
    """Rows whose labels learning leaves out: crc32 of the id as text has this remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == remainder, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit the field to `docs` (doc_id, text) and `labels` (doc_id, toxic), those held out excepted."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    by_hash = F.xxhash64("doc_id"), "doc_id"
    picked = [
        known.filter("toxic" if bad else "NOT toxic").orderBy(*by_hash).limit(n).toPandas()
        for bad, n in ((True, SAMPLE_TOXIC), (False, SAMPLE_CLEAN))
    ]
    clean_only = np.array([-_LIMIT, 0, 0]) if not len(picked[0]) else np.array([_LIMIT, 0, 0])
    plain = np.zeros(1 << FEATURE_BITS), np.zeros(4)
    if not len(picked[0]) or not len(picked[1]):
        return Field(*plain, clean_only)
    spark = docs.sparkSession
    rows = [(int(d), bool(t)) for part in picked for d, t in zip(part["doc_id"], part["toxic"])]
    chosen = F.broadcast(spark.createDataFrame(rows, "doc_id bigint, toxic boolean"))  # SAMPLE_TOXIC + SAMPLE_CLEAN rows
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter(F.octet_length("text") <= SAMPLE_BYTES).join(chosen, "doc_id")
    # Rows that repeat an id must not enlarge the sample.
    sample = texts.orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(len(rows)).toArrow()
    toxic = np.asarray(sample["toxic"], bool) if sample.num_rows else np.zeros(0, bool)
    if toxic.all() or not toxic.any():
        return Field(*plain, np.array([_LIMIT if toxic.any() else -_LIMIT, 0, 0]))
    s = Sequences.of(*utf8(sample["text"]))
    tags = project(s, toxic)
    told = np.bincount(s.doc[tags], minlength=len(toxic)) > 0
    weights, moves = fit(s, tags, (told | ~toxic)[s.doc[s.first]])
    field = Field(weights.astype(np.float32), moves, np.zeros(3))
    return Field(field.weights, moves, logistic(evidence(field.marginals(s), s.doc, len(toxic)), toxic.astype(float)))


def _spans(s: Sequences, p: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end, highest probability) of runs of T within a sequence, in code points of the document."""
    on = np.flatnonzero(p >= 0.5)
    if not len(on):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0),)
    opens = np.zeros(len(p), bool)
    opens[s.first] = True
    new = np.ones(len(on), bool)
    new[1:] = (on[1:] != on[:-1] + 1) | opens[on[1:]]
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(on)) - 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    doc = s.doc[on[a]]
    start, end = points[s.starts[on[a]]], points[s.ends[on[b]]]
    return doc, start - points[offsets[doc]], end - points[offsets[doc]], np.maximum.reduceat(p[on], a)


_FOUND = "score double, spans array<struct<start: bigint, end: bigint, probability: double>>"


def tag(docs: DataFrame, field: Field, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with score and the toxic spans of text: code points [start, end) and probability."""
    held = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def run(batches):
        field = held.value
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            for i, j in slices(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                s = Sequences.of(part, at)
                p = field.marginals(s)
                score = field.score(evidence(p, s.doc, j - i))
                doc, start, end, best = _spans(s, p, part, at)
                spans = pa.StructArray.from_arrays([pa.array(x) for x in (start, end, best)], fields=list(kind.value_type))
                cuts = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), spans)
                columns = [batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score), lists], names=[*keep, "score", "spans"])

    picked = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{fields}, {_FOUND}")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of all documents, learned from those labelled and not held out."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("held_out", held_out())
    found = tag(rows, learn(docs, labels), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
