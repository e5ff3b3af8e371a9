"""Corpus building and word statistics as Spark DataFrame transformations."""
