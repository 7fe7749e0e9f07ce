"""Whole-table operators: DataFrame in, DataFrame out."""
