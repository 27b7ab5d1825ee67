"""Batch operators: DataFrame in, DataFrame out, usable with ``DataFrame.transform``."""
