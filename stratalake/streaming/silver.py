"""Table-to-table stream: typing and expectations between two layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from stratalake.functions.columns import ColumnLike, is_true
from stratalake.operators.quality import expect_or_drop, expect_or_fail
from stratalake.streaming.files import run_append


def stream_silver(
    bronze: DataFrame,
    columns: Mapping[str, ColumnLike],
    target: str,
    checkpoint: str,
    drop: Mapping[str, ColumnLike] | None = None,
    warn: Mapping[str, ColumnLike] | None = None,
    fail: Mapping[str, ColumnLike] | None = None,
    table: bool = False,
) -> tuple[StreamingQuery, dict[str, int]]:
    """Type the columns of a bronze stream, apply expectations, append to silver.

    Rules see the typed columns. Returns the query and, per `warn` and `drop`
    rule, how many rows of this run broke it, over all its micro-batches. The counts
    are taken while rows pass by; nothing is read twice.
    """
    typed = bronze.select(
        *[(F.expr(v) if isinstance(v, str) else v).alias(name) for name, v in columns.items()]
    )
    observed = {**(drop or {}), **(warn or {})}
    if observed:
        typed = typed.observe(
            "expectations", *[F.count_if(~is_true(rule)).alias(name) for name, rule in observed.items()]
        )
    checked = expect_or_fail(expect_or_drop(typed, drop or {}), fail or {})
    counts = dict.fromkeys(observed, 0)

    def add(progress: StreamingQueryProgress) -> None:
        seen = progress.observedMetrics.get("expectations")
        if seen is not None:
            for name, n in seen.asDict().items():
                counts[name] += n or 0

    return run_append(checked, target, checkpoint, table=table, on_progress=add), counts
