"""Quality rules with a ledger: every rule is evaluated once, its failure kept as a bit beside the measurements.

A policy is a set of bits and a version. Applying one, or asking what a rule would change, reads only the ledger.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, and the symbols that prose rarely has.
WHITE = " \\t\\n\\u000B\\u000C\\r"
SYMBOLS = "[#*$%&|<>]"

#: Rules by bit: a failing row makes the expression true. Order is part of stored ledgers; append only.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 16 * n_words",
    "capitals": "100 * n_capitals > 40 * word_chars",
    "digits": "100 * n_digits > 60 * word_chars",
    "bullets": "n_lines > 3 AND 100 * n_bullet_lines > 90 * n_lines",
    "ellipses": "n_lines > 3 AND 100 * n_ellipsis_lines > 30 * n_lines",
}
BASE_RULES = ("few_words", "repeated_words")
MEASURES = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_capitals n_digits n_bullet_lines n_ellipsis_lines"
).split()


@dataclass(frozen=True)
class Policy:
    """A document is kept when none of `required` fails and at most `tolerated` of `counted` fail."""

    version: str
    required: tuple[str, ...]
    counted: tuple[str, ...] = ()
    tolerated: int = 0


#: Version 1 drops what breaks a base rule or any other rule.
POLICIES = {"v1": Policy("v1", tuple(RULES))}


def bit_mask(names, rules: Mapping[str, str] = RULES) -> int:
    place = {name: i for i, name in enumerate(rules)}
    return sum(1 << place[name] for name in set(names))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements of each whole text. Null counts as empty.

    Everything stays inside the row: no shuffle, whatever the length of a text.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = docs.withColumn("_t", body).withColumns(
        {
            # Trimmed first, so that splitting leaves no empty word at either end.
            "_w": F.expr(f"""CASE WHEN trim(BOTH '{WHITE}' FROM _t) = '' THEN CAST(array() AS ARRAY<STRING>)
                             ELSE split(trim(BOTH '{WHITE}' FROM _t), '[ \\\\x09-\\\\x0D]+') END"""),
            "_l": F.expr(f"filter(split(_t, '\\n'), x -> trim(BOTH '{WHITE}' FROM x) <> '')"),
        }
    )
    out = out.withColumn(
        "_g",
        F.expr("""CASE WHEN size(_w) < 3 THEN CAST(array() AS ARRAY<STRUCT<h: BIGINT, p: INT>>) ELSE sort_array(
            transform(sequence(0, size(_w) - 3), i -> struct(xxhash64(_w[i], _w[i + 1], _w[i + 2]) AS h, i AS p))) END"""),
    )
    # Windows found twice stand beside each other; `get` gives null beyond the ends.
    out = out.withColumn(
        "_r", F.expr("filter(_g, (x, i) -> x.h <=> get(_g, i - 1).h OR x.h <=> get(_g, i + 1).h)")
    )
    lost = lambda pattern: F.size(F.split("_t", pattern, -1)) - 1
    return out.withColumns(
        {
            "n_words": F.size("_w").cast("bigint"),
            "word_chars": F.length(F.array_join("_w", "")).cast("bigint"),
            "n_symbols": lost(SYMBOLS).cast("bigint"),
            "n_lines": F.size("_l").cast("bigint"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
            "n_repeat_words": F.expr("size(array_distinct(flatten(transform(_r, x -> array(x.p, x.p + 1, x.p + 2)))))").cast("bigint"),
            "n_capitals": lost("[A-Z]").cast("bigint"),
            "n_digits": lost("[0-9]").cast("bigint"),
            "n_bullet_lines": F.expr("size(filter(_l, x -> x LIKE '- %' OR x LIKE '* %' OR x LIKE '• %'))").cast("bigint"),
            "n_ellipsis_lines": F.expr("size(filter(_l, x -> x LIKE '%...' OR x LIKE '%…'))").cast("bigint"),
        }
    ).drop("_t", "_w", "_l", "_g", "_r")


def ledger(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", rules: Mapping[str, str] = RULES) -> DataFrame:
    """Keys, measurements and `failed`, a bit per rule. Null or empty texts fail what zero words fail.

    Repeated rows stay, each with its own entry; other columns, whatever their names, are left out.
    """
    measured = measure(docs.select(*keys, F.col(text).alias("_text")), "_text").drop("_text")
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, rule in enumerate(rules.values())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed)


def verdict(failed: Column, policy: Policy, rules: Mapping[str, str] = RULES) -> Column:
    """Whether a policy keeps a row with these failure bits."""
    ok = failed.bitwiseAND(F.lit(bit_mask(policy.required, rules))) == 0
    return ok & (F.bit_count(failed.bitwiseAND(F.lit(bit_mask(policy.counted, rules)))) <= policy.tolerated)


def ablation(ledger_rows: DataFrame, policy: Policy, rules: Mapping[str, str] = RULES) -> DataFrame:
    """Per rule of the policy: rows that fail it, that fail only it, and that would be kept without it.

    One aggregate over the ledger, whose partial sums are a row per task.
    """
    failed = F.col("failed")
    names = [n for n in rules if n in policy.required or n in policy.counted]
    kept = verdict(failed, policy, rules)
    sums = []
    for name in names:
        bit = bit_mask([name], rules)
        without = Policy(
            policy.version,
            tuple(n for n in policy.required if n != name),
            tuple(n for n in policy.counted if n != name),
            policy.tolerated,
        )
        sums.append(
            F.struct(
                F.lit(name).alias("rule"),
                F.count_if(failed.bitwiseAND(F.lit(bit)) != 0).alias("n_failed"),
                F.count_if(failed == bit).alias("n_only"),
                F.count_if(verdict(failed, without, rules) & ~kept).alias("n_gained"),
                F.count(F.lit(1)).alias("n_rows"),
            ).alias(name)
        )
    return ledger_rows.agg(*sums).select(F.inline(F.array(*[F.col(f"`{n}`") for n in names])))


def quality_report(docs: DataFrame, policy: Policy = POLICIES["v1"]) -> DataFrame:
    """The ledger of documents (doc_id, text) with a policy's verdict beside the base rules'."""
    failed = F.col("failed")
    base = failed.bitwiseAND(F.lit(bit_mask(BASE_RULES))) != 0
    return (
        ledger(docs)
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & verdict(failed, policy))
        .withColumn("policy", F.lit(policy.version))
    )
