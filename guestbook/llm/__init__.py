"""Operators of a training-data pipeline: deduplication, language, mixing, tokenizing, chat formatting."""
