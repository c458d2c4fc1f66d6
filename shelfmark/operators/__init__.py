"""Operators: DataFrame in, DataFrame out, vocabularies as arguments."""
