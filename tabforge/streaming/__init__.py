"""Applying fitted transformers to streaming DataFrames."""
from tabforge.streaming.scoring import apply_steps, score_stream  # noqa: F401
