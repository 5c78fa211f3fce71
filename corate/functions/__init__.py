"""Column-expression building blocks (built-in Spark functions only)."""

from corate.functions.columns import (  # noqa: F401
    ERROR_BANDS,
    PREDICTION_HEADER,
    band_aggregates,
    centred_pearson,
    guarded_ratio,
    pearson_from_moments,
    sum_normalized,
)
