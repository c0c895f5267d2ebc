"""Corpus operators on DataFrames."""
