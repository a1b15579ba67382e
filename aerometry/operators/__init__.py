"""Operators: DataFrame in, DataFrame out, on batch and where possible on streams."""
