"""The operators as queries over the driver tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.attribution import section_tokens
from stratalake.llm.chat import PART_TURNS, perspectives
from stratalake.llm.collocations import collocations
from stratalake.llm.decontamination import contaminated
from stratalake.llm.jaccard import jaccard_components
from stratalake.llm.langid import identify
from stratalake.llm.packing import pack_documents
from stratalake.llm.parsing import repeat_digest
from stratalake.llm.quality import BASE_RULES, POLICIES, RULES, bit_mask, quality_report
from stratalake.llm.ranking import rank_documents
from stratalake.llm.scoring import score_texts
from stratalake.llm.tokenbin import tokens_round_trip
from stratalake.llm.toxicity import toxicity
from stratalake.llm.workers import share_package

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "byte_bpe_50k.json"

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that gives the same rows if there is one."""

    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            share_package(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query()
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


_WORD = r"[^\x20\x09-\x0D]+"


def _without(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"


@query(
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
                      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
               FROM documents),
    g AS (SELECT doc_id, list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2]) AS g FROM d),
    u AS (SELECT doc_id, unnest(g) AS g, generate_subscripts(g, 1) AS p FROM g),
    c AS (SELECT doc_id, p FROM u QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    r AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM c, (VALUES (0), (1), (2)) AS k(k) GROUP BY doc_id),
    m AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {_without("[#*$%&|<>]")} AS n_symbols,
                 len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
                 {_without("[A-Z]")} AS n_capitals, {_without("[0-9]")} AS n_digits,
                 len(list_filter(l, lambda x: x LIKE '- %' OR x LIKE '* %' OR x LIKE '• %')) AS n_bullet_lines,
                 len(list_filter(l, lambda x: x LIKE '%...' OR x LIKE '%…')) AS n_ellipsis_lines
          FROM d LEFT JOIN r USING (doc_id)),
    f AS (SELECT *, {" + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))} AS failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           (failed & {bit_mask(BASE_RULES)}) <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed
    FROM f"""
)
def op6_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_report(table(spark, sf_dir, "documents"), POLICIES["v1"])
    return report.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )


@query()
def op3_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query()
def op8_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query()
def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query()
def op9_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))


@query()
def op2_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


_SHINGLES = """list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))"""


@query(
    f"""
    WITH i AS (SELECT item_id, w, len(w) AS n, least(len(w), 5) AS k
               FROM (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark) WHERE len(w) > 0),
    si AS (SELECT item_id, n, k, unnest({_SHINGLES}) AS h, generate_subscripts({_SHINGLES}, 1) AS off FROM i),
    d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL),
    dk AS (SELECT doc_id, w, k FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k),
    sd AS (SELECT doc_id, k, unnest({_SHINGLES}) AS h, generate_subscripts({_SHINGLES}, 1) AS p FROM dk),
    c AS (SELECT DISTINCT sd.doc_id, si.item_id, si.n, si.k, greatest(sd.p - si.off, 0) AS start FROM sd JOIN si ON sd.h = si.h AND sd.k = si.k),
    x AS (SELECT c.doc_id, c.item_id, c.start, c.k, d.w[c.start + 1 : c.start + c.n] AS w FROM c JOIN d ON c.doc_id IS NOT DISTINCT FROM d.doc_id),
    y AS (SELECT doc_id, item_id, start, greatest(len(w) - k + 1, 0) AS nw, unnest({_SHINGLES}) AS h FROM x),
    a AS (SELECT doc_id, item_id, start, nw, h, count(*) AS cw FROM y GROUP BY ALL),
    b AS (SELECT item_id, h, count(*) AS ci FROM si GROUP BY ALL),
    m AS (SELECT doc_id, a.item_id, start, nw, sum(least(cw, ci)) AS c FROM a JOIN b ON a.item_id = b.item_id AND a.h = b.h GROUP BY ALL),
    s AS (SELECT doc_id, m.item_id, start, c / (nw + n - k + 1 - c) AS similarity FROM m JOIN i ON m.item_id = i.item_id
          WHERE 100 * c >= 75 * (nw + n - k + 1 - c))
    SELECT doc_id, item_id, start, similarity FROM s
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1"""
)
def op4_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# No text opens or closes a turn: marks get a backslash more.
_TEXT = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"
_NAME = r"regexp_replace({}, '\|(\\*)>', '|\\\1>', 'g')".format(_TEXT)


@query(
    f"""
    WITH r AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
                      coalesce(CAST(floor(turn / {PART_TURNS}) AS BIGINT), -1) AS part FROM conversations),
    s AS (SELECT DISTINCT conv_id, speaker AS perspective FROM r WHERE speaker <> 'system'),
    t AS (SELECT r.conv_id, perspective, part, turn, speaker, speaker = perspective AS mine,
                 CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>'
                      ELSE '<|user name=' || {_NAME.format("speaker")} || '|>' END || chr(10) AS head,
                 text, {_TEXT.format("text")} || chr(10) || '<|end|>' || chr(10) AS body
          FROM r JOIN s ON r.conv_id = s.conv_id),
    u AS (SELECT *, sum(length(head) + length(body)) OVER w AS upto, row_number() OVER w AS nth
          FROM t WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY part, turn NULLS FIRST, speaker, text
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (mine) AS n_trained,
           string_agg(head || body, '' ORDER BY nth) AS rendered,
           coalesce(string_agg(CAST(upto - length(body) AS BIGINT) || '-' || CAST(upto AS BIGINT), ',' ORDER BY nth) FILTER (mine), '') AS mask
    FROM u GROUP BY conv_id, perspective, part"""
)
def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(table(spark, sf_dir, "conversations"))


@query()
def op7_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query(
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
    c AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
    s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM c),
    i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
    u AS (SELECT r, unnest(w) AS t FROM d),
    f AS (SELECT r, t, count(*) AS tf FROM u SEMI JOIN i USING (t) GROUP BY r, t),
    q AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, s GROUP BY t, docs),
    x AS (SELECT item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
          FROM i JOIN q USING (t) JOIN f USING (t) JOIN c USING (r), s GROUP BY item_id, r)
    SELECT item_id, CAST(row_number() OVER o AS INTEGER) AS rank, doc_id, score
    FROM x JOIN c USING (r) WHERE score > 0
    WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER o <= 50"""
)
def op11_blocked_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    f"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece
               FROM documents WHERE text IS NOT NULL),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
    g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
          FROM w, (VALUES (1), (2), (3)) AS k(k)),
    f AS (SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY lang, k, phrase),
    n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 10),
    x AS (SELECT c.*, j, array_to_string(w[1 : j], ' ') AS lp, array_to_string(w[j + 1 :], ' ') AS rp FROM c, (VALUES (1), (2)) AS j(j) WHERE j < k),
    s AS (SELECT x.*, l.c AS l, r.c AS r, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l.c AS HUGEINT) * r.c) AS BIGINT) AS score
          FROM x JOIN f l ON x.lang = l.lang AND x.lp = l.phrase JOIN f r ON x.lang = r.lang AND x.rp = r.phrase),
    m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    h AS (SELECT lang, sub, max(a) AS longer
          FROM (SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS sub FROM c WHERE k = 3) GROUP BY lang, sub)
    SELECT m.lang, CAST(row_number() OVER o AS INTEGER) AS rank, phrase, a, l, r, n, score
    FROM m JOIN n ON m.lang = n.lang LEFT JOIN h ON m.lang = h.lang AND m.phrase = h.sub
    WHERE longer IS NULL OR 100 * longer < 50 * a
    WINDOW o AS (PARTITION BY m.lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000"""
)
def op13_hat_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query()
def op12_random_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    offsets = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("spans").cast("bigint").alias("n_spans"), F.array_join(offsets, ",").alias("offsets"))
