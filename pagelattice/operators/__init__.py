"""Relational and record-level operators: DataFrame in, DataFrame out."""
