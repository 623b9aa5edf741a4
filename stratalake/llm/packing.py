"""Packing of token pieces into sequences by bin completion with branch and bound.

Only the lengths of pieces matter, and there are no more of them than a sequence has tokens. So the plan is made on the
histogram of lengths, whatever the number of pieces: how many sequences have which lengths in them. Pieces are
then numbered within their length, and take the places of the plan by number.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.bpe import Encoder
from stratalake.llm.textbytes import slices, utf8
from stratalake.sources.storage import stored

#: Fillings looked at, half of them in each order, before the search settles for the best packing so far.
NODES = 20_000
#: Fillings of longest pieces that the second order looks ahead for the one of least waste.
AHEAD = 48
#: A packing is finished by best fit when the tokens left have shrunk to this share since it was last done.
SHRUNK = 0.98

Pattern = tuple[tuple[int, int], ...]  # (length, how many of it in one sequence), longest first


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on a histogram: the fullest open sequence that still has room takes the next piece."""
    # Open sequences of the same content stay together, keyed by the room they have left.
    room: dict[int, dict[Pattern, int]] = {capacity: {}}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for free in sorted(r for r in room if length <= r < capacity):
            while left and room.get(free):
                content, n = next(iter(room[free].items()))
                each = min(free // length, left)
                used = min(n, left // each)
                left -= used * each
                n -= used
                if n:
                    room[free][content] = n
                else:
                    del room[free][content]
                room.setdefault(free - each * length, {})
                grown = (*content, (length, each))
                into = room[free - each * length]
                into[grown] = into.get(grown, 0) + used
            if not left:
                break
        if left:
            each = capacity // length
            for k, n in ((each, left // each), (left % each, 1)):
                if k and n:
                    into = room.setdefault(capacity - k * length, {})
                    into[((length, k),)] = into.get(((length, k),), 0) + n
    return [(content, n) for patterns in room.values() for content, n in patterns.items() if content and n]


def reachable(counts: Mapping[int, int], lengths: list[int], room: int) -> list[int]:
    """Bit s of entry i: pieces of lengths[i:], no more of a length than there are, can add up to s."""
    sums, mask = [1], (1 << (room + 1)) - 1
    for size in reversed(lengths):
        bits, n, step = sums[-1], min(counts[size], room // size), 1
        while n:
            used = min(step, n)
            bits |= bits << (used * size)
            n -= used
            step *= 2
        sums.append(bits & mask)
    return sums[::-1]


def fillings(counts: Mapping[int, int], room: int, most_waste: int, ahead: int = 0) -> Iterator[Pattern]:
    """All ways to fill `room` but for at most `most_waste`.

    Least waste first, then longest pieces first; or, with `ahead`, longest pieces first, and of each `ahead` of these
    the least waste first. Only sums that the pieces left can reach are followed, so no step ends without a filling.
    Below no waste there is none.
    """
    if most_waste < 0:
        return
    lengths = sorted((x for x, n in counts.items() if n and x <= room), reverse=True)
    sums = reachable(counts, lengths, room)

    def between(at: int, need: int, waste: int) -> Iterator[Pattern]:
        """Fillings by pieces from `at` on that add up to `need`, or up to `waste` less."""
        for i in range(at, len(lengths)):
            size = lengths[i]
            for n in range(min(counts[size], need // size), 0, -1):
                left = need - n * size
                low = max(0, left - waste)
                if sums[i + 1] >> low & ((1 << (left - low + 1)) - 1):
                    for rest in between(i + 1, left, waste):
                        yield ((size, n), *rest)
            low = max(0, need - waste)
            if not sums[i + 1] >> low & ((1 << (need - low + 1)) - 1):
                return
        if need <= waste:
            yield ()

    if not ahead:
        for waste in range(min(most_waste, room) + 1):
            if sums[0] >> (room - waste) & 1:
                yield from between(0, room - waste, 0)
        return
    longest = between(0, room, most_waste)
    while some := list(itertools.islice(longest, ahead)):
        yield from sorted(some, key=lambda f: -sum(size * n for size, n in f))


def _upwards(bits: int, reach: int) -> int:
    """The bits, and those up to `reach` above each."""
    done = 0
    while done < reach:
        step = min(done + 1, reach - done)
        bits |= bits << step
        done += step
    return bits


def dominated(filling: Pattern, counts: Mapping[int, int], room: int) -> bool:
    """Whether a piece left out could stand in for pieces of the filling: several of them, a shorter one, or none.

    The filling with that piece leaves the replaced ones over, which fit wherever it would have gone, so it is as good.
    """
    waste = room - sum(size * n for size, n in filling)
    some = several = 0  # sums of one piece or more, and of two or more
    for size, n in filling:
        for _ in range(n):
            several |= (several | some) << size
            some |= (some | 1) << size
    replaced = _upwards(several, waste)
    if waste:
        replaced |= _upwards(sum(1 << (size + 1) for size, _ in filling) | 2, waste - 1)
    taken = dict(filling)
    out = sum(1 << size for size, n in counts.items() if n > taken.get(size, 0))
    return bool(replaced & out)


def least_sequences(counts: Mapping[int, int], capacity: int) -> int:
    """A number of sequences below which no packing gets.

    Of pieces of half a sequence or more no two share one (but for two halves); for each length up to half, those so long
    that no such piece fits beside them are full, and what of the shorter ones does not fit beside the others is over.
    """
    best = -(-sum(x * n for x, n in counts.items()) // capacity)
    for short in sorted(x for x in counts if 2 * x <= capacity):
        alone = sum(n for x, n in counts.items() if x > capacity - short)
        large = [(x, n) for x, n in counts.items() if capacity - short >= x > capacity / 2]
        small = sum(x * n for x, n in counts.items() if short <= x <= capacity / 2)
        shared = sum(n for _, n in large)
        over = small - sum((capacity - x) * n for x, n in large)
        best = max(best, alone + shared + max(0, -(-over // capacity)))
    return max(best, sum(n for x, n in counts.items() if 2 * x > capacity))


def bin_completion(histogram: Mapping[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Sequences for a histogram of lengths, as (content, how many): as few as the search finds.

    Depth first: the longest piece left gets an undominated filling, used as often as the counts allow or once, then the
    rest follows. A filling whose waste rules out fewer sequences than the best packing so far has is not followed. Best
    fit of all, and of what is left along the way, are packings to better. The search is made with fillings of least
    waste first, then with those of longest pieces first. It ends at the lower bound, when nothing is left to try
    (the packing is then the best there is), or after `nodes` fillings, dominated ones included, with the best known.
    """
    counts = {length: n for length, n in histogram.items() if n}
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("a piece is longer than a sequence")
    total = sum(length * n for length, n in counts.items())
    least = least_sequences(counts, capacity)
    best = best_fit(counts, capacity)
    most = sum(n for _, n in best)

    def choices(left: dict[int, int], waste: int, ahead: int) -> Iterator[tuple[Pattern, int, int] | None]:
        top = max(left)
        others = {**left, top: left[top] - 1}
        room = capacity - top
        for rest in fillings(others, room, (most - 1) * capacity - total - waste, ahead):
            if dominated(rest, others, room):
                yield None
                continue
            content = dict(rest)
            content = ((top, content.pop(top, 0) + 1), *content.items())
            times = min(left[x] // n for x, n in content)
            lost = capacity - sum(x * n for x, n in content)
            yield content, times, lost
            if times > 1:
                yield content, 1, lost

    for ahead in (0, AHEAD) if counts else ():
        stack = [(counts, 0, 0, choices(counts, 0, ahead), [], total * SHRUNK)]
        seen = 0
        while stack and seen < nodes // 2 and most > least:
            left, used, waste, options, plan, finish = stack[-1]
            option = next(options, ())
            if option == ():
                stack.pop()
                continue
            seen += 1
            spare = (most - 1) * capacity - total - waste
            if option is None or option[2] > spare:
                continue
            content, times, lost = option
            # As often as the counts allow, as long as the waste leaves room for a better packing.
            if lost:
                times = min(times, spare // lost)
            rest = dict(left)
            for x, n in content:
                rest[x] -= n * times
                if not rest[x]:
                    del rest[x]
            now, used, waste = [*plan, (content, times)], used + times, waste + lost * times
            tokens = total - (used * capacity - waste)
            if tokens <= finish:
                finish = tokens * SHRUNK
                finished = best_fit(rest, capacity)
                if used + sum(n for _, n in finished) < most:
                    most, best = used + sum(n for _, n in finished), [*now, *finished]
            if rest:
                stack.append((rest, used, waste, choices(rest, waste, ahead), now, finish))
        if not stack:
            break  # all was tried
    return best


def _cut(tokenizer: str, end_id: int, capacity: int):
    def run(batches):
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets):
                ids, at = encoder.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ids = np.insert(ids, at[1:], end_id).astype("<u4")
                at = at + np.arange(len(at))
                sizes = np.diff(at)
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(j - i), pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = (sizes - 1) % capacity + 1  # the first piece takes what is over
                start = np.where(nth == 0, 0, first[doc] + (nth - 1) * capacity)
                length = np.where(nth == 0, first[doc], capacity)
                raw = ids.tobytes()
                begin = 4 * (at[doc] + start)
                sums = [zlib.crc32(raw[a : a + n]) for a, n in zip(begin.tolist(), (4 * length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(doc)), *map(pa.array, (nth.astype(np.int32), start, length, sums))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents with their end id, cut where longer than a sequence."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(
        _cut(tokenizer, end_id, capacity), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def _places(plan: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, numbers up to, first sequence, how many in a sequence, offset of the first of them)."""
    numbered: dict[int, int] = {}
    rows, sequence = [], 0
    for content, times in plan:
        offset = 0
        for length, each in content:
            first = numbered.get(length, 0)
            rows.append((length, first, first + times * each, sequence, each, offset))
            numbered[length] = first + times * each
            offset += length * each
        sequence += times
    return rows


def place_pieces(cut: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """Add sequence_id and offset to stored pieces with a `length` of 1 to `capacity`.

    Numbering within a length is by bucket, so that a length that most pieces have is spread over many tasks. What
    reaches the driver is the histogram, and what it sends out is the plan: a row per length and content.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = _places(bin_completion(histogram, capacity))
    plan = spark.createDataFrame(
        rows, "length bigint, first bigint, upto bigint, sequence bigint, each bigint, at bigint"
    )
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed = cut.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    numbered = bucketed.withColumn("inside", inside).join(sizes, ["length", "bucket"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("inside")).drop("bucket", "before", "inside")
    # The plan has at most a row per length and content, and contents at most one more than lengths and search steps.
    placed = numbered.alias("p").join(
        F.broadcast(plan.alias("q")),
        (F.col("p.length") == F.col("q.length")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("upto")),
    )
    nth = F.col("number") - F.col("first")
    return placed.select(
        "p.*",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + (nth % F.col("each")) * F.col("p.length")).cast("bigint").alias("offset"),
    ).drop("number")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Pack all documents (doc_id, text) into as few sequences of at most `capacity` tokens as the search finds.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are just their
    end id. Repeated rows are packed as often as they come. An empty table gives an empty result.
    """
    cut = stored(pieces(docs, tokenizer, end_id, capacity), "pieces")
    return place_pieces(cut, capacity, ["doc_id", "piece", "start", "ids_crc32"])
