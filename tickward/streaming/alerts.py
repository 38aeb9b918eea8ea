"""Rules evaluated on every micro-batch of ticks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickward.plans.cycle import Rules, run_turn
from tickward.schemas import RULE_KEY
from tickward.sources.commits import BatchId
from tickward.streaming.ingest import start_batches


def alert_stream(
    ticks: DataFrame,
    load_rules: Callable[[SparkSession], DataFrame | Rules],
    out: str,
    checkpoint: str,
    *,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = RULE_KEY,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Run one turn per micro-batch over its latest ticks, each rule alerting once.

    Rules are read again per batch, as a table or as ``read_rules`` gives them. A replayed batch
    whose turn ended is not run again; a new checkpoint goes on with the next turn and the log of
    all turns before.
    """

    def handle(batch: DataFrame, batch_id: BatchId) -> None:
        if not batch.isEmpty():
            rules = load_rules(batch.sparkSession)
            rows, folded = rules if isinstance(rules, Rules) else (rules, -1)
            run_turn(rows, batch, out, tiebreak=tiebreak, keys=keys, folded=folded, batch_id=batch_id)

    return start_batches(ticks, handle, checkpoint, trigger)
