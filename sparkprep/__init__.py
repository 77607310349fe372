"""Corpus preparation for language-model training as Spark DataFrame operators."""

__version__ = "0.1.0"
