"""N-gram Jaccard join by universe partition and pigeonhole, exact, with components instead of all pairs.

Two sets of s and t shingles with Jaccard similarity p/100 or more differ in at most (s + t)(100 - p)/(100 + p)
shingles. Shingles are hashed into segments, more of them for larger sets (one layout per size band). If two sets
differ in fewer shingles than a record's segments can absorb, some segment has the same subset in both, or
one that is apart by one shingle; so each record publishes the hashes of its segment subsets, and in the segments that
the cost model allots a one-deletion neighbourhood also those of the subsets with one shingle left out.

A record publishes its segments in their fixed order only until they absorb more differences than any
partner allows. Whichever of two records stops first is covered by what both have published.

A list is the records that publish the same hash. Where it was made, parity sketches that bound the difference from below
rule out pairs without losing a link, and a spanning forest of the pairs they leave is told: its trees are the families.
Whatever two records a family holds, no pair of them is written down: its texts meet once, and all its members are compared
there, exactly, as long as their components differ. A family too large for one task is dealt into blocks; across blocks only
those outside its largest component meet the others. Lists too long to be looked at whole, if they hold several families,
and records whose segments are too empty to be covered take an exact second way: prefixes of their rarest shingles.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.graph import connected_components
from stratalake.llm.textbytes import (
    U64,
    distinct_by_document,
    mix,
    shingles,
    slices,
    sums_by,
    utf8,
    word_hashes,
)
from stratalake.sources.storage import stored

#: Segments beyond what the largest set of a band needs, as a share; they make up for empty segments.
SLACK = 1.25
#: Of a list of more members than this only runs of so many are looked at, and some pivots with all.
MAX_LIST = 4_000
PIVOTS = 32
#: Words of sketches that are compared at a time, and possible pairs that a task gathers before it thins them out.
COMPARED = 1_000_000
HELD_PAIRS = 250_000
#: Shingles, and sets, of a family that one task compares with each other or with as many others.
BLOCK_SHINGLES = 1_000_000
BLOCK_SETS = 4_000
#: A set's parity sketch has one to two bits for each shingle, between 64 and this many words of 64; every shingle flips a
#: bit. Two sketches, the longer one folded, differ in no more bits than the sets in shingles.
SKETCH_WORDS = 512
#: Members of a list that are stored in one row.
LIST_ROW = 1_000
#: Published hashes are shuffled in packets, this many for each reducer from each map step.
PACKETS = 4
#: Published hashes that a map task gathers before it sends packets.
GATHER = 2_000_000

_SALT = U64(0x9E3779B97F4A7C15)


def most_apart(total: np.ndarray | int, percent: int):
    """Most shingles that two sets of `total` shingles together may differ in."""
    return total * (100 - percent) // (100 + percent)


@functools.cache
def layout(band: int, percent: int) -> tuple[int, int]:
    """(segments, how many of the last ones get a one-deletion neighbourhood) of sets of 2^band to 2^(band+1)-1.

    Chosen by cost over all splits that absorb enough: hashes published by a set of middle size, and
    the expected number of empty segments, which weaken coverage, weighed four times.
    """
    size = 1.5 * 2**band
    need = math.ceil(SLACK * (most_apart(2 * (2 ** (band + 1) - 1), percent) + 1))
    best = None
    for wide in {0, need // 4, need // 2} | set(range(min(need // 2, 8) + 1)):
        m = need - wide
        cost = (m - wide) + wide * (1 + size / m) + 4 * m * math.exp(-size / m)
        if best is None or (cost, wide) < best:
            best = (cost, wide)
    return need - best[1], best[1]


def published(flat: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document index) of all published subsets, and whether each document is covered.

    `flat` holds the distinct shingle hashes of documents, `offsets` where each begins.
    """
    sizes = np.diff(offsets)
    n = len(sizes)
    covered = np.ones(n, bool)
    largest = sizes * 100 // percent
    band = np.zeros(n, np.int64)
    band[sizes > 0] = np.floor(np.log2(sizes[sizes > 0])).astype(np.int64)
    out_hash, out_doc = [], []
    # One entry for each document and band: its own, and those above it that hold larger partners.
    docs, bands = [], []
    up = 0
    while True:
        present = (sizes > 0) & (largest >= 2 ** (band + up)) if up else sizes > 0
        if not present.any():
            break
        who = np.flatnonzero(present)
        docs.append(who)
        bands.append(band[who] + up)
        up += 1
    if not docs:
        return np.zeros(0, U64), np.zeros(0, np.int64), covered
    docs, bands = np.concatenate(docs), np.concatenate(bands)
    s = sizes[docs]
    partner = np.minimum(largest[docs], 2 ** (bands + 1) - 1)
    apart = most_apart(s + partner, percent)
    keep = apart > 0  # else only equal sets are similar, and those are one class already
    docs, bands, s, apart = docs[keep], bands[keep], s[keep], apart[keep]
    if not len(docs):
        return np.zeros(0, U64), np.zeros(0, np.int64), covered
    plan = {b: layout(int(b), percent) for b in np.unique(bands)}
    m = np.array([plan[b][0] for b in bands])
    wide = np.array([plan[b][1] for b in bands])
    at = np.concatenate([[0], np.cumsum(m)])
    # Every shingle of every entry, and the segment it falls into.
    entry = np.repeat(np.arange(len(docs)), s)
    within = np.arange(len(entry)) - np.repeat(np.cumsum(s) - s, s)
    token = flat[offsets[docs][entry] + within]
    spread = mix(token ^ _SALT)
    slot = at[entry] + (((spread >> U64(32)) * m[entry].astype(U64)) >> U64(32)).astype(np.int64)
    value = mix(token + _SALT)
    sums = np.zeros(at[-1], U64)
    np.add.at(sums, slot, value)
    counts = np.bincount(slot, minlength=at[-1])
    owner = np.repeat(np.arange(len(docs)), m)
    segment = np.arange(at[-1]) - at[owner]
    double = segment >= (m - wide)[owner]
    weight = np.where(counts == 0, 0, np.where(double & (counts > 1), 2, 1))
    so_far = np.cumsum(weight)
    before = so_far - weight
    base = np.concatenate([[0], so_far])[at[:-1]]
    published_here = (counts > 0) & (before - base[owner] <= apart[owner])
    reached = so_far[at[1:] - 1] - base
    np.logical_and.at(covered, docs, reached > apart)
    place = mix(segment.astype(U64) * U64(64) + bands[owner].astype(U64) + _SALT)
    out_hash.append(mix(sums[published_here] + place[published_here]))
    out_doc.append(docs[owner[published_here]])
    left_out = (published_here & double & (counts > 1))[slot]
    out_hash.append(mix(sums[slot[left_out]] - value[left_out] + place[slot[left_out]]))
    out_doc.append(docs[entry[left_out]])
    return np.concatenate(out_hash), np.concatenate(out_doc), covered


def sketches(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets) of the parity sketch of each set."""
    sizes = np.diff(offsets)
    band = np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    words = 2 ** np.clip(band - 5, 0, int(math.log2(SKETCH_WORDS)))
    at = np.concatenate([[0], np.cumsum(words)])
    bit = (mix(flat + U64(3)) & np.repeat(words * 64 - 1, sizes).astype(U64)).astype(np.int64)
    odd = np.bincount(bit + np.repeat(at[:-1] * 64, sizes), minlength=at[-1] * 64).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64), at


def document_sets(column: pa.Array, k: int):
    """(first row, sorted distinct shingle hashes, offsets) of slices of a text column."""
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        words, doc = word_hashes(part, at)
        yield i, *distinct_by_document(*shingles(words, doc, j - i, k), j - i)


_PACKET = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def _publish(parts: int, k: int, percent: int):
    def run(batches):
        waiting, size, turn = [], 0, 0

        def packets():
            h = np.concatenate([x for x, _ in waiting])
            node = np.concatenate([x for _, x in waiting])
            part = ((h >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
            order = np.argsort(part.astype(np.uint16 if parts < 2**16 else np.int64), kind="stable")
            h, node = h[order], node[order]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            # The packet's number stands for the upper bits, so 40 more tell hashes apart; a chance match is verified away.
            low, high = h.astype(np.uint32), (h >> U64(32)).astype(np.uint8)
            rows = [
                (p, 0, low[a:b].tobytes() + high[a:b].tobytes(), node[a:b].tobytes())
                for p, (a, b) in enumerate(zip(cuts, cuts[1:]))
                if b > a
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PACKET.types)], schema=_PACKET)

        for batch in batches:
            ids = batch.column(0)
            for i, flat, offsets in document_sets(batch.column(1), k):
                n = len(offsets) - 1
                first, second = sums_by(mix(flat + U64(1)), offsets), sums_by(mix(flat + U64(2)), offsets)
                h, doc, covered = published(flat, offsets, percent)
                bits, upto = sketches(flat, offsets)
                waiting.append((h, first[doc]))
                size += len(h)
                told = pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, n),
                        pa.array(np.diff(offsets)),
                        pa.array(first.view(np.int64)),
                        pa.array(second.view(np.int64)),
                        pa.array(covered),
                        pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(bits)),
                    ],
                    names=["doc_id", "n", "h1", "h2", "covered", "sketch"],
                )
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, told.schema) as writer:
                    writer.write_batch(told)
                turn += 1
                rows = [[turn * 7919 % parts], [1], [sink.getvalue().to_pybytes()], [None]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _PACKET.types)], schema=_PACKET)
                if size >= GATHER:
                    yield packets()
                    waiting, size = [], 0
        if size:
            yield packets()

    return run


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("covered", pa.bool_()),
        ("sketch", pa.list_(pa.int64())),
        ("part", pa.int32()),
        ("list_id", pa.int64()),
        ("members", pa.list_(pa.int64())),
    ]
)


def _lists(h: np.ndarray, node: np.ndarray):
    """Distinct lists of two nodes or more: (nodes, offsets), nodes ascending in each."""
    order = np.argsort(h)
    h, node = h[order], node[order]
    same = h[1:] == h[:-1]
    shared = np.zeros(len(h), bool)
    shared[1:] |= same
    shared[:-1] |= same
    h, node = h[shared], node[shared]
    if not len(h):
        return node, np.zeros(1, np.int64)
    group = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
    order = np.lexsort((node.view(np.int64), group))
    group, node = group[order], node[order]
    fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (node[1:] != node[:-1])])
    group, node = group[fresh], node[fresh]
    sizes = np.bincount(group)
    at = np.concatenate([[0], np.cumsum(sizes)])
    ids = sums_by(mix(node + _SALT), at)
    _, first = np.unique(ids, return_index=True)
    first = first[sizes[first] > 1]
    keep = np.zeros(len(sizes), bool)
    keep[first] = True
    return node[keep[group]], np.concatenate([[0], np.cumsum(sizes[keep])])


def _collect(batches):
    hashes, nodes, seen = [], [], 0
    for batch in batches:
        for part, kind, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
            if kind:
                with pa.ipc.open_stream(a.as_buffer()) as reader:
                    for told in reader:
                        n = len(told)
                        blank = [pa.nulls(n, f.type) for f in list(_FOUND)[6:]]
                        yield pa.RecordBatch.from_arrays([*told.columns, *blank], schema=_FOUND)
            else:
                seen = part
                nodes.append(np.frombuffer(b.as_buffer(), U64))
                n = len(nodes[-1])
                low = np.frombuffer(a.as_buffer(), np.uint32, n).astype(U64)
                high = np.frombuffer(a.as_buffer(), np.uint8, n, 4 * n).astype(U64)
                hashes.append(low | (high << U64(32)) | (U64(part) << U64(40)))
    if not hashes:
        return
    node, at = _lists(np.concatenate(hashes), np.concatenate(nodes))
    del hashes, nodes
    sizes = np.diff(at)
    ids = sums_by(mix(node + _SALT), at).view(np.int64)
    node = node.view(np.int64)
    # A long list takes several rows.
    rows = -(-sizes // LIST_ROW)
    of = np.repeat(np.arange(len(sizes)), rows)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
    begins = at[of] + nth * LIST_ROW
    for i in range(0, len(of), 20_000):
        part = slice(i, i + 20_000)
        lo = begins[part]
        hi = np.minimum(lo + LIST_ROW, at[of[part] + 1])
        members = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], hi - lo[0]]).astype(np.int32)), pa.array(node[lo[0] : hi[-1]])
        )
        n = len(lo)
        blank = [pa.nulls(n, f.type) for f in list(_FOUND)[:6]]
        yield pa.RecordBatch.from_arrays(
            [*blank, pa.array([seen] * n, pa.int32()), pa.array(ids[of[part]]), members], schema=_FOUND
        )


def _sets_of(k: int):
    """Shingle sets of (node, text), where the text is the node's: a repeated doc_id may bring another."""

    def run(batches):
        for batch in batches:
            for i, flat, offsets in document_sets(batch.column(1), k):
                node = batch.column(0).slice(i, len(offsets) - 1)
                sets = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))
                own = sums_by(mix(flat + U64(1)), offsets).view(np.int64) == node.to_numpy(zero_copy_only=False)
                key = batch.column(2).slice(i, len(node))
                yield pa.RecordBatch.from_arrays([key, node, sets], names=["key", "node", "shingles"]).filter(pa.array(own))

    return run


def _bits_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def _forest(a: np.ndarray, b: np.ndarray, apart: np.ndarray, n: int) -> np.ndarray:
    """Which pairs (a, b) make a spanning forest of the closest ones; all ties are settled alike everywhere."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    order = np.lexsort((b, a, apart))
    for i, x, y in zip(order.tolist(), a[order].tolist(), b[order].tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            kept.append(i)
    return np.array(kept, np.int64)


def _possible(na, nb, apart, percent: int):
    """Whether sets of na and nb shingles that differ in `apart` or more can be similar."""
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & ((100 + percent) * apart <= (100 - percent) * (na + nb))


def _index_pairs(k: int, most: int):
    """Index pairs of a list of k members, about `most` at a time: all, or those of runs and of pivots with all."""
    run = min(k, MAX_LIST)
    for low in range(0, k, run):
        high = min(low + run, k)
        step = max(1, most // run)
        for i in range(low, high, step):
            x, y = np.nonzero(np.arange(i, min(i + step, high))[:, None] < np.arange(low, high))
            yield x + i, y + low
    if run < k:
        pivots = np.arange(PIVOTS) * k // PIVOTS
        for i in range(0, k, step := max(1, most // PIVOTS)):
            x, y = np.nonzero(np.arange(i, min(i + step, k))[:, None] != pivots)
            yield x + i, pivots[y]


def _closest(percent: int):
    """A spanning forest, the closest first, of the pairs in a part's lists that sizes and sketches do not rule out.

    So a family of near copies gives no more pairs than it has members.
    """

    def run(key, lists: pa.Table, nodes: pa.Table) -> pa.Table:
        known, first = np.unique(nodes.column("node").to_numpy(), return_index=True)
        size = nodes.column("n").to_numpy()[first]
        column = nodes.column("sketch").combine_chunks()
        words = pc.list_value_length(column).to_numpy()
        flat, begins = column.flatten().to_numpy().view(U64), np.cumsum(words) - words
        words, begins = words[first], begins[first]
        # The sketches of all nodes that have so many words or more, folded to that length, and each node's row there.
        folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        held, rows_of = np.zeros((0, 2 * SKETCH_WORDS), U64), np.zeros(0, np.int64)
        w = SKETCH_WORDS
        while w:
            own = np.flatnonzero(words == w)
            held = np.concatenate([held[:, :w] ^ held[:, w:], flat[begins[own][:, None] + np.arange(w)]])
            rows_of = np.concatenate([rows_of, own])
            row = np.full(len(known), -1)
            row[rows_of] = np.arange(len(rows_of))
            folded[w] = held, row
            w //= 2
        lists = lists.sort_by("list_id")  # the rows of a long list stand together
        members = lists.column("members").combine_chunks()
        lengths = pc.list_value_length(members).to_numpy()
        ids = lists.column("list_id").to_numpy()
        where = np.searchsorted(known, members.flatten().to_numpy())
        begin = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
        at = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.append(at[begin], at[-1])
        sizes = np.diff(bounds)
        empty = np.zeros(0, np.int64)
        held_a, held_b, held_far, waiting = [empty], [empty], [np.zeros(0)], 0

        def thin():
            a, b, far = (np.concatenate(x) for x in (held_a, held_b, held_far))
            kept = _forest(a, b, far, len(known))
            held_a[:], held_b[:], held_far[:] = [a[kept]], [b[kept]], [far[kept]]

        shortest = np.minimum.reduceat(words[where], bounds[:-1]) if len(sizes) else sizes
        # Lists of the same length are looked at together.
        for k, w in {*zip(sizes.tolist(), shortest.tolist())}:
            which = np.flatnonzero((sizes == k) & (shortest == w))
            sketch, row = folded[w]
            for i, j in _index_pairs(k, COMPARED // w):
                step = max(1, COMPARED // w // max(1, len(i)))
                for c in range(0, len(which), step):
                    rows = where[bounds[which[c : c + step]][:, None] + np.arange(k)]
                    x, y = rows[:, i].ravel(), rows[:, j].ravel()
                    apart = _bits_apart(sketch[row[x]], sketch[row[y]])
                    good = _possible(size[x], size[y], apart, percent)
                    x, y, apart = x[good], y[good], apart[good]
                    # Folded to the shortest of the list, long sketches tell little; pairs of such are looked at in full.
                    wide = np.minimum(words[x], words[y])
                    for v in np.unique(wide[wide > w]).tolist():
                        (full, at_row), p = folded[v], np.flatnonzero(wide == v)
                        for u in np.array_split(p, 1 + len(p) * v // COMPARED):
                            apart[u] = _bits_apart(full[at_row[x[u]]], full[at_row[y[u]]])
                    good = _possible(size[x], size[y], apart, percent)
                    held_a.append(np.minimum(x, y)[good])
                    held_b.append(np.maximum(x, y)[good])
                    held_far.append((apart / (size[x] + size[y]))[good])
                    waiting += len(held_a[-1])
                    if waiting > HELD_PAIRS:
                        thin()
                        waiting = 0
        thin()
        return pa.table({"a": pa.array(known[held_a[0]]), "b": pa.array(known[held_b[0]])})

    return run


def _families(pairs: DataFrame) -> DataFrame:
    return stored(connected_components(pairs), "jaccard-families")


def _similar(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, placed: DataFrame, percent: int, k: int) -> DataFrame:
    """Links among the pairs (a, b) of one family each, by exact intersection: at least those that make the same components.

    Pairs of the same two blocks of a family (node, family, slot) are verified together, so that a set does not travel with
    every pair.
    """
    keyed = pairs.join(placed.select(F.col("node").alias("a"), "family", F.col("slot").alias("slot_a")), "a")
    keyed = keyed.join(placed.select(F.col("node").alias("b"), F.col("slot").alias("slot_b")), "b")
    key = F.xxhash64("family", F.least("slot_a", "slot_b"), F.greatest("slot_a", "slot_b"))
    keyed = stored(keyed.select("a", "b", key.alias("key")), "jaccard-keyed")
    asked = keyed.select("key", "a").union(keyed.select("key", "b")).toDF("key", "node").distinct()
    sets = _sets(texts, nodes, asked, k)
    return keyed.groupBy("key").cogroup(sets.groupBy("key")).applyInArrow(_verify(percent), "a bigint, b bigint")


def _verify(percent: int):
    def run(key, pairs: pa.Table, sets: pa.Table) -> pa.Table:
        held: dict[int, list[np.ndarray]] = {}
        for node, shingles_ in zip(sets.column("node").to_pylist(), sets.column("shingles").combine_chunks()):
            held.setdefault(node, []).append(shingles_.values.to_numpy().view(U64))
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        out = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            if find(a) == find(b):
                continue  # links of this block join them already
            for x in held.get(a, ()):
                for y in held.get(b, ()):
                    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                    common = int((x[at] == y).sum())
                    if find(a) != find(b) and 100 * common >= percent * (len(x) + len(y) - common):
                        root[find(a)] = find(b)
                        out.append((a, b))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _texts_of(texts: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of `wanted` (node, ...) with the texts of their nodes.

    A node is the first hash of a class; where two classes share it by chance, both have their texts. A repeated doc_id may
    bring texts of other nodes.
    """
    chosen = stored(nodes.select("node", "doc_id").join(wanted, "node"), "jaccard-chosen")
    # Repeated rows go; the join has brought them together.
    same = texts.join(chosen, "doc_id").withColumn("same", F.xxhash64("text")).dropDuplicates(["doc_id", *wanted.columns, "same"])
    return same.select(*wanted.columns, "text")


def _sets(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(key, node, shingles) of the wanted (key, node), made again from their texts."""
    picked = _texts_of(texts, nodes, wanted).select("node", "text", "key")
    return picked.mapInArrow(_sets_of(k), "key bigint, node bigint, shingles array<bigint>")


def _group_sets(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, shingle hashes, offsets): the sets of those rows (node, text) whose text is the node's."""
    node = table.column("node").to_numpy()
    rows, sets, ends = [np.zeros(0, np.int64)], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for i, flat, offsets in document_sets(table.column("text"), k):
        own = sums_by(mix(flat + U64(1)), offsets).view(np.int64) == node[i : i + len(offsets) - 1]
        rows.append(i + np.flatnonzero(own))
        sets.append(flat[np.repeat(own, np.diff(offsets))])
        ends.append(np.diff(offsets)[own])
    return np.concatenate(rows), np.concatenate(sets), np.concatenate([[0], np.cumsum(np.concatenate(ends))]).astype(np.int64)


def _places(offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the items of the sets `which` stand, one set after the other, and the offsets of these."""
    at = np.concatenate([[0], np.cumsum(offsets[which + 1] - offsets[which])])
    return np.arange(at[-1]) + np.repeat(offsets[which] - at[:-1], np.diff(at)), at


def unite(flat: np.ndarray, offsets: np.ndarray, component: np.ndarray, percent: int, asks: np.ndarray | None = None):
    """Links (x, y) that join the components of similar sets, and the components after them.

    Every set is compared with all later ones, or each that asks with all that do not, unless they are joined already. A
    look at sketches of one length spares most intersections.
    """
    m, sizes = len(offsets) - 1, np.diff(offsets)
    component = component.copy()
    _, token = np.unique(flat, return_inverse=True)
    marked = np.zeros(len(flat), bool)
    w = 2 ** min(max(int(sizes.max()).bit_length() - 5, 0), int(math.log2(SKETCH_WORDS)))
    sketch = np.zeros(m * w, U64)
    bit = mix(flat + U64(3)) & U64(w * 64 - 1)
    at = np.repeat(np.arange(m) * w, sizes) + (bit >> U64(6)).astype(np.int64)
    np.bitwise_xor.at(sketch, at, U64(1) << (bit & U64(63)))
    sketch = sketch.reshape(m, w)
    links = []
    others = np.arange(m) if asks is None else np.flatnonzero(~asks)
    for x in range(m) if asks is None else np.flatnonzero(asks).tolist():
        near = others[x + 1 :] if asks is None else others
        near = near[component[near] != component[x]]
        apart = _bits_apart(sketch[near], sketch[x])
        near = near[_possible(sizes[near], sizes[x], apart, percent)]
        if not len(near):
            continue
        own = token[offsets[x] : offsets[x + 1]]
        marked[own] = True
        places, at = _places(offsets, near)
        common = sums_by(marked[token[places]].astype(np.int64), at)
        marked[own] = False
        near = near[100 * common >= percent * (sizes[near] + sizes[x] - common)]
        joined, first = np.unique(component[near], return_index=True)
        if len(joined):
            links += [(x, y) for y in near[first].tolist()]
            component[np.isin(component, joined)] = component[x]
    return links, component


def _inside(percent: int, k: int):
    """(node, component) of the members of each family or block of one; component is its least node."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("family", "ascending"), ("slot", "ascending"), ("node", "ascending")])
        rows, flat, offsets = _group_sets(table, k)
        node, family, slot = (table.column(c).to_numpy()[rows] for c in ("node", "family", "slot"))
        fresh = (family[1:] != family[:-1]) | (slot[1:] != slot[:-1])
        cuts = np.concatenate([[0], np.flatnonzero(fresh) + 1, [len(rows)]]) if len(rows) else [0]
        component = np.zeros(len(rows), np.int64)
        for i, j in zip(cuts, cuts[1:]):
            # Nodes ascend, so the first of a component is its least.
            _, found = unite(flat[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], node[i:j], percent)
            _, first, of = np.unique(found, return_index=True, return_inverse=True)
            component[i:j] = node[i:j][first[of]]
        _, first = np.unique(node, return_index=True)
        return pa.table({"node": pa.array(node[first]), "component": pa.array(component[first])})

    return run


def _between(percent: int, k: int):
    """Links (a, b) of a block's members that ask with those of another that do not, across components."""

    def run(table: pa.Table) -> pa.Table:
        rows, flat, offsets = _group_sets(table, k)
        node, component, asks = (table.column(c).to_numpy(zero_copy_only=False)[rows] for c in ("node", "component", "asks"))
        links, _ = unite(flat, offsets, component, percent, asks) if len(rows) else ([], None)
        a, b = (node[[link[i] for link in links]] if links else np.zeros(0, np.int64) for i in (0, 1))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return run


def _blocks() -> Column:
    return F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_SETS))


def _united(texts: DataFrame, nodes: DataFrame, closest: DataFrame, families: DataFrame, percent: int, k: int, buckets: int) -> DataFrame:
    """(node, component) of the members of `families` (node, component): the exact components within each.

    Texts travel once. In a family of several blocks the pairs `closest` that lead from one to another join what is alike, and
    then only members outside the family's largest component travel to the other blocks.
    """
    sized = families.select("node", F.col("component").alias("family")).join(nodes.select("node", "n"), "node")
    size = sized.groupBy("family").agg(_blocks().alias("blocks"))
    placed = sized.select("node", "family").distinct().join(size, "family")
    placed = stored(placed.withColumn("slot", F.pmod(F.xxhash64("node"), F.col("blocks"))), "jaccard-placed")
    key = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(buckets))).otherwise(F.xxhash64("family", "slot"))
    members = _texts_of(texts, nodes, placed.select("node", "family", "slot", key.alias("key")))
    inside = members.groupBy("key").applyInArrow(_inside(percent, k), "node bigint, component bigint")
    inside = stored(inside, "components")
    large = placed.filter("blocks > 1")
    if large.isEmpty():
        return inside

    at = stored(large.join(inside, "node"), "jaccard-large")
    cross = closest.join(at.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a")
    cross = cross.join(at.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b").filter("ca <> cb").select("a", "b")
    components = _merged(inside, _similar(texts, nodes, cross, large, percent, k))
    at = large.join(components, "node").join(nodes.groupBy("node").agg(F.max("n").alias("n")), "node")
    top = at.groupBy("family", "component").agg(F.count("*").alias("c")).groupBy("family").agg(F.max_by("component", F.struct("c", "component")).alias("top"))
    at = stored(at.join(top, "family").withColumn("asks", F.col("component") != F.col("top")), "jaccard-large")
    asking = at.filter("asks").groupBy("family").agg(_blocks().alias("asking"))
    at = at.join(asking, "family")
    first = F.sequence(F.lit(0).cast("bigint"), F.col("asking") - 1)
    others = at.withColumn("asks", F.lit(False)).withColumn("first", F.explode(first)).withColumn("second", F.col("slot"))
    second = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    those = at.filter("asks").withColumn("first", F.pmod(F.xxhash64("node"), F.col("asking"))).withColumn("second", F.explode(second))
    wanted = others.unionByName(those).select("node", "component", "asks", F.xxhash64("family", "first", "second").alias("key"))
    links = _texts_of(texts, nodes, wanted).groupBy("key").applyInArrow(_between(percent, k), "a bigint, b bigint")
    return _merged(components, links)


def _with_component(nodes: DataFrame, components: DataFrame) -> DataFrame:
    return nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components of the graph that has these links (a, b) besides."""
    links = links.join(components.withColumnsRenamed({"node": "a", "component": "ca"}), "a", "left")
    links = links.join(components.withColumnsRenamed({"node": "b", "component": "cb"}), "b", "left")
    merged = connected_components(links.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    top = components.join(merged.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left")
    known = top.select("node", F.coalesce("top", "component").alias("component"))
    return stored(known.unionByName(merged.join(known, "node", "left_anti")), "components")


def _rare_prefix_pairs(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of `nodes` (node, component, sketch) across components, here families, that share one of their rarest shingles.

    Two sets of similarity p/100 share a shingle within the first size - ceil(size * p / 100) + 1 of each, in any
    order that is common to all sets; rarest first keeps the lists short.
    """
    tokens = sets.join(nodes.drop("sketch"), "node").select(
        "node", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("token")
    )
    spread = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("component").alias("c1"), F.max("component").alias("c2"))
    shared = stored(tokens.join(spread.filter("c1 <> c2"), "token").select("node", "component", "n", "token", "df"), "rare")
    # Shingles of one component only come first in the order: they cannot join anything, but take up places.
    own = shared.groupBy("node").agg(F.count("*").alias("m"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "token"))
    length = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    prefix = shared.join(own, "node").withColumn("rank", rank).filter(F.col("rank") + F.col("n") - F.col("m") <= length)
    prefix = prefix.select("node", "component", "n", "token").join(nodes.select("node", "sketch"), "node")
    other = prefix.select(
        F.col("node").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), "token", F.col("sketch").alias("other")
    )
    # Sketches of one length rule out most pairs that are not similar, as in the lists.
    apart = F.aggregate(
        F.zip_with("sketch", "other", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x
    )
    near = (100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("nb"))
    pairs = prefix.join(other, "token").filter(
        (F.col("component") < F.col("cb"))
        & (100 * F.col("n") >= percent * F.col("nb"))
        & (100 * F.col("nb") >= percent * F.col("n"))
        & ((F.size("sketch") != F.size("other")) | near)
    )
    return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, percent: int = 75, k: int = 5, parts: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs` (doc_id, text).

    Words are lower-cased in A-Z; a document's set is its distinct k-word shingles, its whole word sequence if it has
    fewer words, and empty without words. Two documents link when 100 * intersection >= percent *
    union. component_id is the least doc_id that links reach. Null and empty texts have no links. Equal sets
    are one class, compared once. A repeated doc_id keeps its rows. An empty table gives an empty result.
    Sets are compared by 64-bit shingle hashes.
    """
    spark = docs.sparkSession
    reducers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or PACKETS * reducers
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    packets = texts.mapInArrow(_publish(parts, k, percent), "part int, kind int, a binary, b binary")
    found = packets.repartition(reducers, "part").mapInArrow(
        _collect,
        "doc_id bigint, n bigint, h1 bigint, h2 bigint, covered boolean, sketch array<bigint>, part int, list_id bigint, members array<bigint>",
    )
    found = stored(found, "jaccard")
    rows = found.filter("list_id IS NULL").select("doc_id", "n", "h1", "h2", "covered")
    classes = found.filter("list_id IS NULL AND n > 0").groupBy("h1", "h2")
    classes = stored(
        classes.agg(F.min("doc_id").alias("doc_id"), F.min("covered").alias("covered"), F.max("n").alias("n"), F.first("sketch").alias("sketch")),
        "jaccard-classes",
    )
    nodes = classes.select(F.col("h1").alias("node"), "h2", "doc_id", "n", "sketch")
    lists = found.filter("list_id IS NOT NULL").select("part", "list_id", "members")
    asked = lists.select(F.col("part").alias("where"), F.explode("members").alias("node")).distinct()
    told = asked.join(nodes.select("node", "n", "sketch"), "node").select("where", "node", "n", "sketch")
    looked = lists.groupBy("part").cogroup(told.groupBy("where")).applyInArrow(_closest(percent), "a bigint, b bigint")
    closest = stored(looked.distinct(), "jaccard-closest")
    families = _families(closest)  # and of all possible pairs, which these connect
    components = _united(texts, nodes, closest, families, percent, k, parts)

    # What is left: long lists of several families, and uncovered records. All within a family have been compared.
    long = lists.groupBy("part", "list_id").agg(F.sum(F.size("members")).alias("k")).filter(F.col("k") > MAX_LIST).drop("k")
    long = lists.join(long, ["part", "list_id"]).select("list_id", F.explode("members").alias("node")).distinct()
    long = stored(_with_component(long, families), "jaccard-long")
    mixed = long.groupBy("list_id").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 <> c2")
    rest = long.join(mixed, "list_id", "left_semi").select("node").union(classes.filter("NOT covered").select("h1"))
    rest = stored(_with_component(rest.distinct(), families), "jaccard-rest")
    if rest.limit(2).count() == 2:
        sets = stored(_sets(texts, nodes, rest.select("node", F.lit(0).cast("bigint").alias("key")), k), "jaccard-sets")
        across = stored(_rare_prefix_pairs(sets, rest.join(nodes.select("node", "sketch"), "node"), percent), "jaccard-across")
        if not across.isEmpty():
            again = _united(texts, nodes, across, _families(across), percent, k, parts)
            components = _merged(components, again.toDF("a", "b"))

    nodes = nodes.select("node", "h2", "doc_id")
    tops = _with_component(nodes, components).groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found_in = _with_component(nodes, components).join(tops, "component").select(F.col("node").alias("h1"), "h2", "component_id")
    return rows.join(found_in, ["h1", "h2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
