"""Analyses: each is ``(tables, **params) -> DataFrame``, built lazily."""
