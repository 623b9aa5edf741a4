"""Benchmark decontamination: item-sized windows found by shared shingles, exact check.

Every shingle of every document is probed against the benchmark's; a hit says where a window of the item's own
length would have to begin. Every such window is verified by weighted shingle similarity. SimHashes are not used: a
hit names item and place already, so a Hamming radius could only drop windows that the check accepts. Windows that no
shared shingle puts in line with the item are not tried. Only DataFrame functions are used; documents are exploded and filtered in one stage, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.sources.storage import stored

#: Words of a shingle; items of fewer words are one shingle.
SHINGLE = 5
#: The benchmark's shingles are sent to all executors up to this many rows of 24 bytes; beyond, both sides are shuffled.
MAX_BROADCAST_SHINGLES = 1_000_000


def _words(text: Column) -> Column:
    # Text that begins or ends with something else has an empty piece there.
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _shingle_rows(df: DataFrame, words: str, k: int, keep: list[str]) -> DataFrame:
    """keep, p, h: hash of every run of k words and its place. Stays inside generated code."""
    zipped = F.arrays_zip(*[F.slice(words, i + 1, F.size(words)).alias(f"w{i}") for i in range(k)])
    rows = df.select(*keep, F.posexplode(zipped).alias("p", "s"))
    full = rows.filter(F.col(f"s.w{k - 1}").isNotNull())
    return full.select(*keep, "p", F.xxhash64(*[F.col(f"s.w{i}") for i in range(k)]).alias("h"))


def _shingle_array(words: str, k: str) -> Column:
    """Hashes of the runs of k words of a short array, as the rows above have them for the same words."""
    whole = " ".join(f"WHEN {k} = {n} THEN xxhash64({', '.join(f'{words}[i + {j}]' for j in range(n))})" for n in range(1, SHINGLE + 1))
    return F.expr(f"""CASE WHEN size({words}) < {k} THEN CAST(array() AS ARRAY<BIGINT>)
        ELSE transform(sequence(0, size({words}) - {k}), i -> CASE {whole} END) END""")


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, item_id, start, similarity) of documents (doc_id, text) that hold a passage like an item (item_id, text).

    Words are runs of letters and digits, lower-cased. A window of as many words as the item has, from word `start` on, is
    like it when the weighted Jaccard similarity of their 5-word shingles is percent/100 or more; a
    shingle's weight is how often it comes. One row per document and item: the most similar window, the first on a tie. Null
    or empty texts and items match nothing. Rows that share a doc_id, null included, are one document with several texts.
    Repeated rows count as one. Other columns are ignored.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), _words(F.col("text").cast("string")).alias("iw"))
    items = items.filter("size(iw) > 0").distinct().withColumns({"n": F.size("iw"), "k": F.least(F.size("iw"), F.lit(SHINGLE))})
    items = items.withColumn("ih", _shingle_array("iw", "k")).select("item_id", "n", "k", "ih")
    items = stored(items, "benchmark")
    index = items.select("item_id", "n", "k", F.posexplode("ih").alias("off", "h"))
    if items.agg(F.sum(F.size("ih"))).first()[0] is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, start bigint, similarity double")
    small = index.limit(MAX_BROADCAST_SHINGLES + 1).count() <= MAX_BROADCAST_SHINGLES

    # Texts are found again by a hash of id and text: ids may be null for many rows.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), _words(F.col("text")).alias("w"))
    hits = None
    for (k,) in items.select("k").distinct().orderBy("k").collect():  # five at most
        side = index.filter(F.col("k") == k).drop("k")
        found = _shingle_rows(texts, "w", k, ["row"]).join(F.broadcast(side) if small else side, "h")
        found = found.select("row", "item_id", "n", F.lit(k).alias("k"), F.greatest(F.col("p") - F.col("off"), F.lit(0)).alias("start"))
        hits = found if hits is None else hits.unionByName(found)
    places = stored(hits.distinct(), "benchmark-hits")

    windows = texts.join(places, "row").select(
        "doc_id", "item_id", "start", "k", F.slice("w", F.col("start") + 1, F.col("n")).alias("ww")
    )
    windows = windows.withColumn("wh", _shingle_array("ww", "k")).filter("size(wh) > 0").drop("ww", "k")
    windows = windows.distinct().withColumn("same", F.xxhash64("wh"))

    # Weighted similarity: sums of the lesser and of the greater weight over all shingles of the two.
    weights = windows.select("doc_id", "item_id", "start", "same", F.size("wh").alias("nw"), F.explode("wh").alias("h"))
    weights = weights.groupBy("doc_id", "item_id", "start", "same", "nw", "h").agg(F.count("*").alias("cw"))
    item_weights = index.groupBy("item_id", "h").agg(F.count("*").alias("ci"))
    sizes = items.select("item_id", F.size("ih").alias("ni"))
    common = weights.join(item_weights, ["item_id", "h"]).groupBy("doc_id", "item_id", "start", "same", "nw").agg(F.sum(F.least("cw", "ci")).alias("c"))
    scored = common.join(sizes, "item_id").withColumn("u", F.col("nw") + F.col("ni") - F.col("c"))
    like = scored.filter(100 * F.col("c") >= percent * F.col("u")).withColumn("similarity", F.col("c") / F.col("u"))
    best = F.max_by(F.struct("start", "similarity"), F.struct("similarity", -F.col("start")))
    return like.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.col("b.start").cast("bigint").alias("start"), F.col("b.similarity").alias("similarity")
    )
