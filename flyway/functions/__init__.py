"""Scalar column expressions (built-in Spark functions only, all codegen-able)."""

from .scalars import (  # noqa: F401
    activity_band, clean_state, cosine, jaccard, month_of, predicted_k, safe_div,
    set_mean, set_std_pop, set_sum,
)
