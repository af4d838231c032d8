"""Operators over any table with the right columns: DataFrame in, DataFrame out."""
