"""Scoring test pairs that arrive on a stream (micro-batches)."""

from corate.streaming.scoring import (  # noqa: F401
    item_based_scorer,
    score_stream,
    user_based_scorer,
)
