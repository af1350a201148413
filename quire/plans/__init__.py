"""Registered analyses over the driver tables: each is a function
``(spark, sf_dir) -> DataFrame`` plus an equivalent DuckDB SQL text."""

from .registry import QUERIES, ORACLE_SQL, register

from . import text, relational, descriptive, lexicon, supervised, embeddings, scaling, comparisons, checks, fixedtopics, exact  # noqa: F401,E402

__all__ = ["QUERIES", "ORACLE_SQL", "register"]
