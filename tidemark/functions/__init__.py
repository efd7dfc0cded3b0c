"""Column expressions shared by the operators."""

from tidemark.functions.binning import BinLabel, BinSpec, bin_expression, step_expression
from tidemark.functions.columns import (
    categorical_columns,
    named,
    numeric_columns,
    quoted,
    unused,
)
from tidemark.functions.hashing import hash_bucket, hash_number
from tidemark.functions.missing import is_missing
from tidemark.functions.numeric import guarded_ratio, pairwise_corr, percent

__all__ = [
    "BinLabel",
    "BinSpec",
    "bin_expression",
    "categorical_columns",
    "guarded_ratio",
    "hash_bucket",
    "hash_number",
    "is_missing",
    "named",
    "numeric_columns",
    "pairwise_corr",
    "percent",
    "quoted",
    "step_expression",
    "unused",
]
