"""Collocations: phrases whose words come together more often than their parts would, by language.

Phrases are counted in a HAT-trie: a shallow trie over word ids whose leaves are hash containers. A container that grows
too large bursts into containers by the next bits of the word ids. A full trie spills its largest subtrees whole, as sorted runs; the
runs of all tasks are merged by ranges of the phrase, so a prefix with very many continuations spans several partitions.

Counting goes by length: a phrase can only be frequent where the two shorter ones in it are, and a bitmap of those
(of bounded size; a full one rules out less and changes no count) spares the trie the rest.

A null text is empty and a null lang is `und`, together with rows that say `und`. Rows that repeat count as often as they
are there. Empty tables, and texts without a frequent phrase, give no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.ranking import top_rows
from stratalake.llm.textbytes import U64, mix, segment_hashes, slices, utf8, word_bounds
from stratalake.sources.storage import stored

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
#: Candidates go where a longer one holds them in this share of their occurrences, in percent.
INSIDE = 50
#: Entries of a container before it bursts, and of a task's trie (or its words) before it spills.
BURST = 65_536
SPILL = 1_000_000
FILTER_BITS = 2**26
#: Bits of a word id that a node of the trie looks at.
FAN_BITS = 4

#: A-Z to lower case, the ends of pieces to line feeds, tabs to spaces.
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[ord("A") : ord("Z") + 1] += 32
_TABLE[list(b".,;:!?\x0b\x0c\x0d")] = 0x0A
_TABLE[0x09] = 0x20
_PLACES = mix(np.arange(1, 65, dtype=U64)) | U64(1)
_RUNS = "lang string, phrase string, n bigint"
_BATCH = 50_000


class Words:
    """The words of a slice of texts: hashes by language, bounds, and whether the next word follows in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.data = _TABLE[data]
        self.starts, self.ends, doc = word_bounds(self.data, offsets)
        names, codes = np.unique(np.array(langs, object), return_inverse=True)
        seeds = segment_hashes(*_joined([x.encode() for x in names]))
        self.names, self.lang = names, codes[doc]
        self.hash = mix(segment_hashes(self.data, self.starts, self.ends) + seeds[self.lang])
        stops = np.concatenate([[0], np.cumsum(self.data == 0x0A, dtype=np.int64)])
        self.next = (doc[1:] == doc[:-1]) & (stops[self.starts[1:]] == stops[self.ends[:-1]])

    @functools.cached_property
    def check(self) -> np.ndarray:
        """A second, independent hash."""
        return segment_hashes(self.data, self.starts, self.ends, 1)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, lies within a piece) of the k words from each word on."""
        n = max(0, len(self.hash) - k + 1)
        h, whole = np.zeros(n, U64), np.ones(n, bool)
        for j in range(k):
            h += self.hash[j : j + n] * _PLACES[j]
            if j:
                whole &= self.next[j - 1 : j - 1 + n]
        return mix(h), whole


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(x) for x in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], ends[:-1]]), ends


def _slices(batch: pa.RecordBatch):
    data, offsets = utf8(batch.column(1))
    langs = batch.column(0).to_pylist()
    for i, j in slices(offsets):
        yield Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], langs[i:j])


class Container:
    """Counts by key in an open hash table; a key is not 0."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = np.zeros(64, U64), np.zeros(64, np.int64), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """`keys` are distinct."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            old = self.entries()
            capacity = 1 << int(4 * (self.size + len(keys)) - 1).bit_length()
            self.keys, self.counts, self.size = np.zeros(capacity, U64), np.zeros(capacity, np.int64), 0
            self._put(*old)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        last = U64(len(self.keys) - 1)
        slot = (mix(keys) & last).astype(np.int64)
        while len(keys):
            empty = self.keys[slot] == 0
            self.keys[slot[empty]] = keys[empty]  # of several keys for a slot one gets it
            mine = self.keys[slot] == keys
            self.counts[slot[mine]] += counts[mine]
            self.size += int((mine & empty).sum())
            keys, counts, slot = keys[~mine], counts[~mine], (slot[~mine] + 1) & int(last)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        used = self.keys > 0
        return self.keys[used], self.counts[used]


class HatTrie:
    """Counts of phrases, given as word ids (from 1) packed into one integer of `bits` bits, the first word highest."""

    def __init__(self, bits: int, burst: int = BURST):
        self.burst = burst
        self.top = -(-bits // FAN_BITS) * FAN_BITS
        self.root: Container | list = Container()
        self.size = 0

    def add(self, phrases: np.ndarray) -> None:
        keys, counts = np.unique(phrases, return_counts=True)
        self.root = self._add(self.root, self.top, keys, counts)

    def _add(self, node, shift: int, keys: np.ndarray, counts: np.ndarray):
        if isinstance(node, Container):
            before = node.size
            node.add(keys, counts)
            self.size += node.size - before
            if node.size <= self.burst or shift < FAN_BITS:
                return node
            self.size -= node.size
            keys, counts = node.entries()
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            node = [Container() for _ in range(1 << FAN_BITS)]
        shift -= FAN_BITS
        child = ((keys >> U64(shift)) & U64((1 << FAN_BITS) - 1)).astype(np.int64)
        cuts = np.searchsorted(child, np.arange((1 << FAN_BITS) + 1))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                node[i] = self._add(node[i], shift, keys[a:b], counts[a:b])
        return node

    def containers(self, node=None) -> list[Container]:
        node = self.root if node is None else node
        return [node] if isinstance(node, Container) else [c for child in node for c in self.containers(child)]

    def spill(self, keep: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Empty containers, the largest first, until at most `keep` entries are left: (phrases, counts) of each."""
        runs = []
        for container in sorted(self.containers(), key=lambda c: -c.size):
            if self.size <= keep:
                break
            self.size -= container.size
            runs.append(container.entries())
            container.__init__()
        return runs


class Filter:
    """A bitmap of frequent phrases; others may pass by chance."""

    def __init__(self, frequent: DataFrame, words: int):
        self.bits = min(FILTER_BITS, 1 << max(10, (32 * frequent.count()).bit_length()))
        self.words, bits = words, self.bits

        def run(batches):
            for batch in batches:
                for w in _slices(batch):
                    h, whole = w.windows(words)
                    slot = np.unique(h[whole] & U64(bits - 1))
                    at, first = np.unique(slot >> U64(6), return_index=True)
                    mask = np.bitwise_or.reduceat(U64(1) << (slot & U64(63)), first) if len(at) else at
                    yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array(mask.view(np.int64))], names=["at", "bits"])

        parts = frequent.select("lang", "phrase").mapInArrow(run, "at bigint, bits bigint")
        parts = parts.groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
        self.data = np.zeros(bits // 64, U64)
        self.data[parts["at"]] = parts["bits"].to_numpy(np.int64).view(U64)

    def may(self, w: Words) -> np.ndarray:
        """Where a phrase of that many words begins that may be frequent."""
        h, whole = w.windows(self.words)
        slot = h & U64(self.bits - 1)
        return whole & ((self.data[slot >> U64(6)] >> (slot & U64(63))) & U64(1)).astype(bool)


class Counter:
    """Counts the phrases of `length` words in one task."""

    def __init__(self, length: int, filters: list[Filter], spill: int):
        self.length, self.filters, self.limit = length, filters, spill
        self.id_bits = 63 // length
        self.trie = HatTrie(self.id_bits * length)
        self.reset()

    def reset(self) -> None:
        """Forget all word ids."""
        self.hashes, self.ids = np.zeros(0, U64), np.zeros(0, np.int64)
        self.checks, self.spelled, self.langs = np.zeros(1, U64), [b""], [""]

    def _ids(self, w: Words, use: np.ndarray) -> np.ndarray:
        """An id of each word in `use`, 0 of all others. Words of equal hash are told apart by the second one."""
        out = np.zeros(len(w.hash), np.int64)
        h, check = w.hash[use], w.check[use]
        while len(h):
            distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
            at = np.searchsorted(self.hashes, distinct)
            new = np.ones(len(distinct), bool)
            inside = at < len(self.hashes)
            new[inside] = self.hashes[at[inside]] != distinct[inside]
            if new.any():
                where = use[first[new]]
                self.spelled += [w.data[a:b].tobytes() for a, b in zip(w.starts[where].tolist(), w.ends[where].tolist())]
                self.langs += w.names[w.lang[where]].tolist()
                self.checks = np.append(self.checks, check[first[new]])
                fresh = np.arange(len(self.spelled) - new.sum(), len(self.spelled))
                self.hashes = np.concatenate([self.hashes, distinct[new]])
                order = np.argsort(self.hashes, kind="stable")
                self.hashes, self.ids = self.hashes[order], np.concatenate([self.ids, fresh])[order]
                at = np.searchsorted(self.hashes, distinct)
            ids = self.ids[at][which]
            other = self.checks[ids] != check
            out[use[~other]] = ids[~other]
            use, h, check = use[other], mix(h[other] + check[other]), check[other]
        return out

    def add(self, w: Words):
        """Count the words of a slice; yields what has to be spilled on the way."""
        n = self.length
        begins = np.ones(len(w.hash), bool) if n == 1 else self.filters[0].may(w)
        if n > 1:
            both = self.filters[-1].may(w)
            begins = both[:-1] & both[1:] & w.windows(n)[1] if len(both) > 1 else both[:0]
        begins = np.flatnonzero(begins)
        # So few at a time that ids cannot run out between two spills.
        step = min(_BATCH * 4, (1 << self.id_bits) // (4 * n))
        for k in range(0, len(begins), step):
            at = begins[k : k + step]
            ids = self._ids(w, np.unique(np.concatenate([at + j for j in range(n)])))
            phrase = np.zeros(len(at), U64)
            for j in range(n):
                phrase = (phrase << U64(self.id_bits)) | ids[at + j].astype(U64)
            self.trie.add(phrase)
            yield from self.spill()

    def spill(self, everything: bool = False):
        """Sorted runs when there is too much, or at the end."""
        crowded = len(self.spelled) > min(self.limit, (1 << self.id_bits) // 4)
        if not (everything or crowded or self.trie.size > self.limit):
            return
        keys = [lang.encode() + b"\0" + word for lang, word in zip(self.langs, self.spelled)]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        rank = np.empty(len(order), U64)
        rank[order] = np.arange(len(order), dtype=U64)
        words = pa.array([self.spelled[i] for i in order], pa.binary())
        langs = pa.array([self.langs[i] for i in order], pa.string())
        low = U64((1 << self.id_bits) - 1)
        shifts = [U64(self.id_bits * (self.length - 1 - j)) for j in range(self.length)]
        for phrases, counts in self.trie.spill(0 if everything or crowded else self.limit // 2):
            parts = [rank[((phrases >> s) & low).astype(np.int64)] for s in shifts]
            turn = np.lexsort(parts[::-1])
            for k in range(0, len(turn), _BATCH):
                some = turn[k : k + _BATCH]
                spelled = [words.take(pa.array(p[some])) for p in parts]
                phrase = pc.binary_join_element_wise(*spelled, b" ") if self.length > 1 else spelled[0]
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(parts[0][some])), phrase.view(pa.string()), pa.array(counts[some])], names=["lang", "phrase", "n"]
                )
        if crowded:
            self.reset()


def count_runs(docs: DataFrame, length: int, filters: list[Filter], spill: int = SPILL) -> DataFrame:
    """(lang, phrase, n): sorted runs of the phrases of `length` words that `filters`, by length, do not rule out."""
    held = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        counter = Counter(length, held.value, spill)
        for batch in batches:
            for words in _slices(batch):
                yield from counter.add(words)
        yield from counter.spill(True)

    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )
    return rows.filter("text IS NOT NULL").mapInArrow(run, _RUNS)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, spill: int = SPILL) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, a) of all phrases of up to max_words words that occur min_count times, (lang, n))."""
    filters: list[Filter] = []
    found = totals = None
    for length in range(1, max_words + 1):
        runs = stored(count_runs(docs, length, filters, spill), f"runs-{length}")
        if length == 1:
            totals = runs.groupBy("lang").agg(F.sum("n").alias("n"))
        merged = runs.repartitionByRange("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("a"))
        frequent = stored(merged.filter(F.col("a") >= min_count).withColumn("words", F.lit(length)), f"phrases-{length}")
        if length < max_words:
            filters.append(Filter(frequent, length))
        found = frequent if found is None else found.union(frequent)
    return found, totals


def _part(first: str, length: str) -> Column:
    return F.expr(f"array_join(slice(w, {first}, {length}), ' ')")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best `top` phrases of 2 to max_words words.

    Reads `docs` (text, lang) once for each length. Products are decimals of 38 digits, exact for counts below 10^16.
    """
    counts, totals = phrase_counts(docs, min_count, max_words)
    candidates = counts.filter("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumns({"left": _part("1", "k"), "right": _part("k + 1", "words - k")})
    parts = counts.select("lang", "phrase", "a")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.toDF("lang", side, name), ["lang", side])
    big = "CAST({} AS DECIMAL(19, 0))".format
    cuts = cuts.withColumn("score", F.expr(f"({big('a')} * {big('a')} * 1000000) div ({big('l')} * {big('r')})"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    held = candidates.filter("words > 2").withColumn("k", F.explode(F.expr("sequence(2, words - 1)")))
    held = held.withColumn("at", F.explode(F.expr("sequence(1, words - k + 1)"))).withColumn("phrase", _part("at", "k"))
    held = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(held, ["lang", "phrase"], "left")
    left = left.filter(F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True))).drop("longer")
    best = top_rows(left, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
