"""Repeated byte strings of a corpus by prefix-free parsing.

Rolling-hash triggers cut every text into phrases, wherever the same bytes stand, so a string that occurs twice is cut
the same way twice. The dictionary (distinct phrases, with how often the corpus has them) rules out nearly all of the
text: a string with a phrase that occurs once occurs once. What is left is parsed again into contexts: all windows
of `size` bytes whose least phrase is the same one belong to it, with the bytes around. Contexts are the dictionary
of the second parse and their places are the parse; only distinct contexts are sorted window by window, which
orders the corpus' suffixes by phrase and then by their first `size` bytes, and equal neighbours are repeats. A
context that occurs twice needs no sorting: all of its windows repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.textbytes import U64, mix, segment_hashes, slices, utf8
from stratalake.sources.storage import stored

#: A trigger looks at this many bytes, and at one before them; one in so many positions is a trigger.
TRIGGER = 8
SPACING = 48
#: Shorter phrases repeat by chance and are passed over. Length counts the bytes of the trigger before the phrase.
SHORTEST = 24
#: Bits of the filter that keeps texts without repeats out of the last shuffle; a full one lets more through.
FILTER_BITS = 2**23

_GATHER = 2_000_000
_random = np.random.default_rng(7_919)
_VALUES = _random.integers(1, 2**32, size=256, dtype=np.uint32)


def phrases(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of all phrases between two triggers of a document, the first trigger's bytes included."""
    h = _VALUES[data]
    for step, factor in ((1, 0x9E3779B1), (2, 0x85EBCA6B), (4, 0xC2B2AE35)):
        if len(h) <= step:
            return (np.zeros(0, np.int64),) * 3
        h = h[:-step] * np.uint32(factor) + h[step:]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    hit = h < np.uint32(2**32 // SPACING)
    hit[1:] &= ~hit[:-1].copy()  # of a row of triggers only the first counts, so that runs of a byte are not cut up
    at = np.flatnonzero(hit)
    at = at[at > 0]
    doc = np.searchsorted(offsets, at, "right") - 1
    inside = (at - 1 >= offsets[doc]) & (at + TRIGGER <= offsets[doc + 1])
    at, doc = at[inside], doc[inside]
    same = doc[1:] == doc[:-1]
    return at[:-1][same] - 1, at[1:][same] + TRIGGER, doc[:-1][same]


def _usable(start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    return (end - start >= SHORTEST) & (end - start <= size)


_PHRASES = pa.schema([("part", pa.int32()), ("hashes", pa.binary()), ("rows", pa.binary()), ("places", pa.binary())])


def _dictionary(parts: int, size: int):
    """Packets of phrase hashes with their row and place in it."""

    def run(batches):
        waiting, n = [], 0

        def packets():
            h, row, place = (np.concatenate(x) for x in zip(*waiting))
            part = ((h >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
            order = np.argsort(part.astype(np.uint16 if parts < 2**16 else np.int64), kind="stable")
            low, high = h[order].astype(np.uint32), (h[order] >> U64(32)).astype(np.uint8)
            row, place = row[order], place[order]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [
                (p, low[a:b].tobytes() + high[a:b].tobytes(), row[a:b].tobytes(), place[a:b].tobytes())
                for p, (a, b) in enumerate(zip(cuts, cuts[1:]))
                if b > a
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PHRASES.types)], schema=_PHRASES)

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in slices(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                start, end, doc = phrases(part, at)
                nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
                use = _usable(start, end, size)
                start, end, doc, nth = start[use], end[use], doc[use], nth[use]
                waiting.append((segment_hashes(part, start, end), rows[i:j][doc], nth.astype(np.uint32)))
                n += len(doc)
                if n >= _GATHER:
                    yield packets()
                    waiting, n = [], 0
        if n:
            yield packets()

    return run


def _repeated(batches):
    """(row, places): the phrases of each row that the corpus has twice or more."""
    hashes, rows, places = [], [], []
    for batch in batches:
        for part, h, r, p in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3)):
            rows.append(np.frombuffer(r.as_buffer(), np.int64))
            places.append(np.frombuffer(p.as_buffer(), np.uint32))
            n = len(rows[-1])
            low = np.frombuffer(h.as_buffer(), np.uint32, n).astype(U64)
            high = np.frombuffer(h.as_buffer(), np.uint8, n, 4 * n).astype(U64)
            hashes.append(low | (high << U64(32)) | (U64(part) << U64(40)))
    if not hashes:
        return
    h, row, place = np.concatenate(hashes), np.concatenate(rows), np.concatenate(places)
    order = np.argsort(h)
    h = h[order]
    same = h[1:] == h[:-1]
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    row, place = row[order][twice], place[order][twice].astype(np.int32)
    order = np.argsort(row, kind="stable")
    row, place = row[order], place[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), pa.array(place))
    for k in range(0, len(first), 20_000):
        yield pa.RecordBatch.from_arrays([pa.array(row[first[k : k + 20_000]]), lists.slice(k, 20_000)], names=["row", "places"])


_CONTEXTS = pa.schema(
    [
        ("key", pa.int64()),
        ("context", pa.int64()),
        ("times", pa.int64()),
        ("doc_id", pa.int64()),
        ("same", pa.int64()),
        ("begin", pa.int64()),
        ("windows", pa.int64()),
        ("bytes", pa.binary()),
    ]
)
_CONTEXTS_SQL = "key bigint, context bigint, times bigint, doc_id bigint, same bigint, begin bigint, windows bigint, bytes binary"


def _table(n: int, **columns) -> pa.RecordBatch:
    made = [
        pa.nulls(n, f.type) if columns.get(f.name) is None else pa.array(columns[f.name], f.type) for f in _CONTEXTS
    ]
    return pa.RecordBatch.from_arrays(made, schema=_CONTEXTS)


def _contexts(size: int):
    """Places of contexts, each distinct one of a slice with its bytes; times is null for what is settled already, and same
    for what has no place outside the slice. A null doc_id stays null."""

    def run(batches):
        for batch in batches:
            ids, same, texts, repeated = (batch.column(k) for k in range(4))
            data, offsets = utf8(texts)
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            ids, same = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in (ids, same))
            for i, j in slices(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                n = len(part)
                start, end, doc = phrases(part, at)
                known = repeated.slice(i, j - i)
                base = np.searchsorted(doc, np.arange(j - i))
                sizes = np.diff(known.offsets.to_numpy())
                twice = np.zeros(len(doc) + 1, bool)
                marked = np.repeat(base, sizes) + known.flatten().to_numpy(zero_copy_only=False)
                twice[np.minimum(marked, len(doc))] = True
                use = _usable(start, end, size)
                once = use & ~twice[:-1]
                # Windows with a phrase that occurs once are out.
                out = np.zeros(n + 2, np.int64)
                np.add.at(out, np.maximum(at[doc[once]], end[once] - size), 1)
                np.add.at(out, start[once] + 1, -1)
                fits = np.zeros(n + 2, np.int64)
                long = np.flatnonzero(np.diff(at) >= size)
                np.add.at(fits, at[long], 1)
                np.add.at(fits, at[long + 1] - size + 1, -1)
                window = np.flatnonzero((np.cumsum(fits)[:n] > 0) & (np.cumsum(out)[:n] <= 0))
                if not len(window):
                    continue
                use &= twice[:-1]
                start, end = start[use], end[use]
                name = segment_hashes(part, start, end)
                lo = np.searchsorted(start, window)
                hi = np.searchsorted(end, window + size, "right") - 1
                bare = window[lo > hi]
                window, lo, hi = window[lo <= hi], lo[lo <= hi], hi[lo <= hi]
                owner = np.searchsorted(at, np.concatenate([window, bare]), "right") - 1
                settled = np.zeros(n + 2, np.int64)  # of windows that the slice itself shows to be repeats
                if len(window):
                    new = np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
                    a, b = lo[new], hi[new]
                    best = a.copy()
                    for k in range(1, int((b - a).max()) + 1):
                        other = np.minimum(a + k, b)
                        best = np.where(name[other] < name[best], other, best)
                    chosen = best[np.cumsum(new) - 1]
                    cut = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)])
                    first = np.flatnonzero(cut)
                    begin, count = window[first], np.diff(np.append(first, len(window)))
                    stop, phrase = begin + count - 1 + size, chosen[first]
                    key = name[phrase].view(np.int64)
                    shift = (start[phrase] - begin).astype(U64)
                    context = mix(segment_hashes(part, begin, stop) + mix(shift * U64(0x9E3779B97F4A7C15))).view(np.int64)
                    _, index, inverse, times = np.unique(context, return_index=True, return_inverse=True, return_counts=True)
                    who = owner[: len(window)][first]
                    done = times[inverse] > 1
                    np.add.at(settled, begin[done], 1)
                    np.add.at(settled, begin[done] + count[done], -1)
                    place = begin - at[who]
                    raw = part.tobytes()
                    alone = times == 1
                    bodies = [raw[x:y] for x, y in zip(begin[index].tolist(), stop[index].tolist())]
                    some = who[index]
                    yield _table(
                        len(index), key=key[index], context=context[index], times=np.minimum(times, 2),
                        doc_id=pa.array(ids[i:j][some], mask=~(alone & valid[i:j][some])), same=pa.array(same[i:j][some], mask=~alone),
                        begin=place[index], windows=count[index], bytes=bodies,
                    )
                if len(bare):
                    # Without a phrase inside, a window stands for itself; equal ones of a slice are sent once.
                    prints = segment_hashes(part, bare, bare + size)
                    _, index, inverse, times = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
                    done = bare[times[inverse] > 1]
                    settled[done] += 1
                    settled[done + 1] -= 1
                    who, alone = owner[len(window) :][index], times == 1
                    yield _table(
                        len(index), key=prints[index].view(np.int64),
                        context=segment_hashes(part, bare[index], bare[index] + size, 1).view(np.int64), times=np.minimum(times, 2),
                        doc_id=pa.array(ids[i:j][who], mask=~(alone & valid[i:j][who])), same=pa.array(same[i:j][who], mask=~alone),
                        begin=bare[index] - at[who], windows=np.ones(len(index), np.int64),
                    )
                done = np.flatnonzero(np.cumsum(settled) > 0)
                if len(done):
                    who = np.searchsorted(at, done, "right") - 1
                    first = np.flatnonzero(np.concatenate([[True], (done[1:] != done[:-1] + 1) | (who[1:] != who[:-1])]))
                    begin, count, who = done[first], np.diff(np.append(first, len(done))), who[first]
                    place = begin - at[who]
                    spread = mix((ids ^ same)[i:j][who].view(U64) * U64(31) + place.astype(U64)).view(np.int64)
                    named = pa.array(ids[i:j][who], mask=~valid[i:j][who])
                    yield _table(len(first), key=spread, doc_id=named, same=same[i:j][who], begin=place, windows=count)

    return run


def _settle(size: int):
    """(doc_id, same, begin, end): repeated stretches in bytes, from all contexts of a set of keys."""

    def spans(ids, named, same, begin, end):
        columns = [pa.array(ids, mask=named == 0), *(pa.array(x) for x in (same, begin, end))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "same", "begin", "end"])

    def run(batches):
        kept, bodies = [], []
        for batch in batches:
            columns = [batch.column(k) for k in range(7)]
            settled = columns[2].is_null().to_numpy(zero_copy_only=False)
            number = [c.fill_null(-1).to_numpy(zero_copy_only=False) for c in columns]
            named, here = (c.is_valid().to_numpy(zero_copy_only=False) for c in columns[3:5])
            if settled.any():
                _, _, _, ids, same, begin, windows = (x[settled] for x in number)
                yield spans(ids, named[settled], same, begin, begin + windows - 1 + size)
            kept.append(np.stack([x[~settled].astype(np.int64) for x in (*number, named, here)]))
            bodies += batch.column(7).filter(pa.array(~settled)).to_pylist()
        if not kept:
            return
        key, context, times, ids, same, begin, windows, named, here = np.concatenate(kept, axis=1)
        if not len(key):
            return
        order = np.lexsort((context, key))
        new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (context[order][1:] != context[order][:-1])])
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(new) - 1
        total = np.bincount(group, times).astype(np.int64)
        whole = (total[group] > 1) & (here > 0)
        yield spans(ids[whole], named[whole], same[whole], begin[whole], begin[whole] + windows[whole] - 1 + size)
        # Windows of distinct contexts, sorted; those of one that occurs twice are repeats already, and show others.
        one = order[new]
        one = np.array([k for k in one.tolist() if bodies[k] is not None], np.int64)
        if not len(one):
            return
        lengths = np.fromiter((len(bodies[k]) for k in one.tolist()), np.int64, len(one))
        data = np.frombuffer(b"".join(bodies[k] for k in one.tolist()), np.uint8)
        del bodies
        at = np.cumsum(lengths) - lengths
        count = windows[one]
        prints, owners, places = [], [], []
        for a, b in slices(np.append(at, len(data))):
            low = at[a]
            part = data[low : at[b - 1] + lengths[b - 1]]
            owner = np.repeat(np.arange(a, b), count[a:b])
            place = np.arange(len(owner)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b])
            where = at[owner] - low + place
            prints.append(segment_hashes(part, where, where + size))
            owners.append(owner)
            places.append(place)
        prints, owner, place = np.concatenate(prints), np.concatenate(owners), np.concatenate(places)
        order = np.argsort(prints)
        same_as = prints[order][1:] == prints[order][:-1]
        twice = np.zeros(len(prints), bool)
        twice[order[1:]] |= same_as
        twice[order[:-1]] |= same_as
        twice &= (total[group[one]] == 1)[owner]
        hit = np.flatnonzero(twice)
        if len(hit):
            new = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[hit][1:] != owner[hit][:-1])])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(hit)) - 1
            k = one[owner[hit[first]]]
            yield spans(ids[k], named[k], same[k], begin[k] + place[hit[first]], begin[k] + place[hit[last]] + size)

    return run


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, same, text): a repeated doc_id with another text is another row; equal rows share their spans."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("same"), text.alias("text"))


def _joined(rows: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """By (doc_id, same), where a null doc_id equals another."""
    found = found.withColumnsRenamed({"doc_id": "_doc_id", "same": "_same"})
    on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("same") == F.col("_same"))
    return rows.join(found, on, how).drop("_doc_id", "_same")


def repeated_spans(docs: DataFrame, size: int = 400) -> DataFrame:
    """(doc_id, same, begins, ends): for each row with repeats, stretches of bytes (they may overlap) in which every byte
    is covered by a `size`-byte string that also starts elsewhere in the corpus. `same` is xxhash64 of the text. Rows with a
    null doc_id are rows like others.
    """
    spark = docs.sparkSession
    reducers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _rows(docs)
    key = F.xxhash64("doc_id", "same")
    packets = rows.select(key.alias("row"), "text").mapInArrow(
        _dictionary(4 * reducers, size), "part int, hashes binary, rows binary, places binary"
    )
    repeated = packets.repartition(reducers, "part").mapInArrow(_repeated, "row bigint, places array<int>")
    repeated = repeated.groupBy("row").agg(F.flatten(F.collect_list("places")).alias("places"))
    parsed = rows.filter(F.octet_length("text") >= size).withColumn("row", key).join(repeated, "row", "left")
    nothing = F.expr("CAST(array() AS ARRAY<INT>)")
    contexts = parsed.select("doc_id", "same", "text", F.coalesce("places", nothing).alias("places"))
    contexts = contexts.mapInArrow(_contexts(size), _CONTEXTS_SQL)
    spans = contexts.repartition(reducers, "key").mapInArrow(_settle(size), "doc_id bigint, same bigint, begin bigint, end bigint")
    spans = spans.groupBy("doc_id", "same").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return stored(spans.select("doc_id", "same", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends")), "repeats")


def _marks(bits: int):
    def run(batches):
        found = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            np.bitwise_or.at(found, *_bit(batch.column(0).to_numpy(zero_copy_only=False), bits))
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()])], names=["bits"])

    return run


def _bit(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.view(U64)) % U64(bits)
    return (h >> U64(3)).astype(np.int64), np.uint8(1) << (h & U64(7)).astype(np.uint8)


_CUT_SQL = "doc_id bigint, same bigint, n_removed bigint, n_spans bigint, kept string"


def _cut_out(text: bool):
    """Rows with their repeats cut out: either the text that is left, or its digest."""

    def run(batches):
        for batch in batches:
            bodies, made = batch.column(2), []
            for body, begins, ends in zip(bodies, batch.column(3), batch.column(4)):
                raw = np.frombuffer(body.as_buffer(), np.uint8)
                cover = np.zeros(len(raw) + 1, np.int64)
                np.add.at(cover, begins.values.to_numpy(), 1)
                np.add.at(cover, ends.values.to_numpy(), -1)
                gone = np.cumsum(cover)[:-1] > 0
                left = raw[~gone].tobytes()
                runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                made.append((int(gone.sum()), runs, left.decode("utf-8", "ignore") if text else hashlib.sha256(left).hexdigest()))
            removed, runs, left = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(left, pa.string())],
                names=["doc_id", "same", "n_removed", "n_spans", "kept"],
            )

    return run


def _filter_of(spans: DataFrame):
    """A filter of fixed size on the rows that have spans, as a broadcast; it may let others through."""
    keys = spans.select(F.xxhash64("doc_id", "same").alias("row")).mapInArrow(_marks(FILTER_BITS), "bits binary")
    found = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in keys.toLocalIterator():
        found |= np.frombuffer(r["bits"], np.uint8)
    return spans.sparkSession.sparkContext.broadcast(found)


def _chosen(rows: DataFrame, place, wanted: bool) -> DataFrame:
    """Those rows (doc_id, same, ..) that the filter lets through, or those that it does not."""

    def run(batches):
        for batch in batches:
            byte, bit = _bit(batch.column(0).to_numpy(zero_copy_only=False), FILTER_BITS)
            yield batch.filter(pa.array(((place.value[byte] & bit) > 0) == wanted))

    keyed = rows.select(F.xxhash64("doc_id", "same").alias("_row"), *rows.columns)
    return keyed.mapInArrow(run, keyed.schema).drop("_row")


def repeat_digest(docs: DataFrame, size: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of (doc_id, text) without its repeats.

    A byte goes if a `size`-byte string over it also starts anywhere else, in the same row or another; strings overlap,
    never cross rows, and are judged on the input. A null text counts as empty, a null doc_id stays null. Repeated rows
    repeat each other.
    """
    spans = repeated_spans(docs, size)
    likely = _chosen(_rows(docs).filter(F.octet_length("text") >= size), _filter_of(spans), True)
    joined = _joined(likely, spans).select("doc_id", "same", F.col("text").cast("binary"), "begins", "ends")
    found = joined.mapInArrow(_cut_out(text=False), _CUT_SQL).dropDuplicates(["doc_id", "same"])
    rows = _rows(docs).select("doc_id", "same", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
    return _joined(rows, found, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, size: int = 400) -> DataFrame:
    """`docs` with the repeats cut out of `text`; a character cut in half goes whole, and so does a row left empty.

    All columns stay as they are but for n_chars, where there is one: it follows a text that changes. Rows without repeats
    pass by without a shuffle, null and empty texts among them. A null doc_id stays null.
    """
    spans = repeated_spans(docs, size)
    place = _filter_of(spans)
    keyed = docs.select(F.struct(*docs.columns).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    keyed = keyed.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("same"), "row")
    untouched = _chosen(keyed, place, False).select("row.*")
    joined = _joined(_chosen(keyed, place, True), spans, "left")
    nothing = F.expr("CAST(array() AS ARRAY<BIGINT>)")
    joined = joined.withColumns({"begins": F.coalesce("begins", nothing), "ends": F.coalesce("ends", nothing)})

    def run(batches):
        cut = _cut_out(text=True)
        for batch in batches:
            texts = batch.column(2).field("text").fill_null("").cast(pa.binary())
            given = pa.RecordBatch.from_arrays([*batch.columns[:2], texts, *batch.columns[3:]], names=list("abcde"))
            for done in cut([given]):
                yield pa.RecordBatch.from_arrays([batch.column(2), done.column(2), done.column(4)], names=["row", "n_removed", "kept"])

    fields = f"row {joined.schema['row'].dataType.simpleString()}, n_removed bigint, kept string"
    changed = joined.mapInArrow(run, fields).filter("n_removed = 0 OR kept <> ''")
    touched = F.col("n_removed") > 0
    new = {"text": F.when(touched, F.col("kept")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(touched, F.length("kept")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return untouched.unionByName(changed.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]))
