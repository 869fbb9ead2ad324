"""Curation, search, packing and evaluation of tables on Spark."""
