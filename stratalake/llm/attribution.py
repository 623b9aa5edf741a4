"""Token counts of the sections of a document, from one encoding of the whole text.

Encoding each section by itself counts other tokens than the document has. Here the text is encoded once, tokens and
sections are intervals of its characters, and every token is counted in the section a rule names.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.bpe import Encoder
from stratalake.llm.textbytes import slices, utf8

#: start: the section of a token's first byte. end: of its last byte. most: the one with most of its bytes, the earlier
#: on a tie. split: each section gets its share of the bytes.
RULES = ("start", "end", "most", "split")


def token_lengths(path: str) -> np.ndarray:
    """Bytes of each token of a byte-level vocabulary file, whose entries spell a byte per character."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    vocabulary = model["model"]["vocab"]
    sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        sizes[i] = len(token)
    for token in model.get("added_tokens", []):
        sizes = np.pad(sizes, (0, max(0, token["id"] + 1 - len(sizes))))
        sizes[token["id"]] = len(token["content"].encode())
    return sizes


def attribute(
    begins: np.ndarray, ends: np.ndarray, sections: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """(tokens per section, tokens that cross into or out of it) for tokens [begin, end) over sections that
    start at `sections` and reach to the next one; all ascend and the first section starts at or before all tokens."""
    n = len(sections)
    first = np.searchsorted(sections, begins, "right") - 1
    last = np.searchsorted(sections, np.maximum(ends - 1, begins), "right") - 1
    crosses = np.flatnonzero(first != last)
    count = np.zeros(n)
    crossing = np.zeros(n, np.int64)
    home = last if rule == "end" else first
    whole = np.ones(len(begins), bool)
    if rule in ("most", "split"):
        whole[crosses] = False
    count += np.bincount(home[whole], minlength=n)
    for t in crosses.tolist():
        a, b = first[t], last[t]
        crossing[a : b + 1] += 1
        if rule in ("most", "split"):
            bounds = np.concatenate([[begins[t]], sections[a + 1 : b + 1], [ends[t]]])
            share = np.diff(bounds)
            if rule == "most":
                count[a + int(share.argmax())] += 1
            else:
                count[a : b + 1] += share / share.sum()
    return count, crossing


def _count(tokenizer: str, rule: str):
    def run(batches):
        encoder, sizes = Encoder.of(tokenizer), token_lengths(tokenizer)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                ids, upto = encoder.encode(part, at)
                ends = np.cumsum(sizes[ids])
                begins = ends - sizes[ids]
                if len(part) and (not len(ends) or ends[-1] != len(part)):
                    raise ValueError("the tokenizer does not keep every byte")
                # A section is a line with its end; an empty document has none.
                starts = np.union1d(at[:-1][at[:-1] < at[1:]], np.flatnonzero(part == 0x0A) + 1)
                starts = starts[starts < len(part)]
                count, crossing = attribute(begins, ends, starts, rule)
                doc = np.searchsorted(at, starts, "right") - 1
                heads = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])  # characters before each byte
                base = heads[at[doc]]
                nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
                stop = np.append(starts[1:], len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i).take(pa.array(doc)),
                        pa.array(nth.astype(np.int32)),
                        pa.array(heads[starts] - base),
                        pa.array(heads[stop] - base),
                        pa.array(count),
                        pa.array(crossing),
                    ],
                    names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
                )

    return run


def section_tokens(docs: DataFrame, tokenizer: str, rule: str = "most") -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing): tokens of every line of every text (doc_id, text).

    A section is a line with its line end, [start, end) in characters. n_tokens adds up to the tokens of the whole text;
    it is whole but for the rule `split`. Null and empty texts have no sections. Repeated rows are counted each.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}")
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(
        _count(tokenizer, rule), "doc_id bigint, section int, start bigint, end bigint, n_tokens double, n_crossing bigint"
    )
