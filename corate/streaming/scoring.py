"""Structured Streaming front end for the neighbourhood predictors.

The reference is batch only. This module adds no operator: it lets the
batch item-based / user-based predictor score (user, item) pairs that arrive
on a stream. The similarity table is computed once from the training set and
materialized (written to the shared checkpoint folder when the session names
one, cached otherwise); every micro-batch is a stream-static join against it
and the training table, run by ``foreachBatch``. Each epoch writes its own output folder with overwrite, so
a replayed epoch (after a failure) replaces its output instead of
duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corate.plans import pipelines as P
from corate.session import materialize

Scorer = Callable[[DataFrame], DataFrame]


def item_based_scorer(
    prep: P.Prepared, k: int = 10, metric: str = "pearson", fallback: str = "user_mean"
) -> Scorer:
    """pairs (user, item[, rating]) -> item-based predictions."""
    sims = materialize(P.item_pairs(prep, metric), "auto", "item-sims")

    def score(pairs: DataFrame) -> DataFrame:
        return P.item_based(prep, k, metric, fallback, sims=sims, pairs=pairs).predictions

    return score


def user_based_scorer(prep: P.Prepared, k: int = 1, loo: str = "literal") -> Scorer:
    """pairs (user, item[, rating]) -> user-based predictions."""
    sims = materialize(P.user_pairs(prep)[0], "auto", "user-sims")

    def score(pairs: DataFrame) -> DataFrame:
        return P.user_based(prep, k, loo, sims=sims, pairs=pairs).predictions

    return score


def score_stream(
    pairs_stream: DataFrame,
    scorer: Scorer,
    output_path: str,
    checkpoint_location: str,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start a query that scores each micro-batch of pairs.

    Output: parquet under ``output_path/epoch=<id>``. ``checkpoint_location``
    is the stream's own shared folder; a restart must name the same one, or its
    epochs start at 0 again and replace earlier output.
    """
    ckpt = checkpoint_location

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        cols = ["user", "item"] + (["rating"] if "rating" in batch.columns else [])
        out = scorer(batch.select(*cols).dropDuplicates(["user", "item"]))
        out.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/epoch={epoch_id}")

    w = pairs_stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
