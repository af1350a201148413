"""Structured Streaming: the stateless text operators applied to a stream of
documents, with running aggregates kept in Spark's state store."""

from .incremental import stream_documents, running_term_counts, dictionary_scores_stream

__all__ = ["stream_documents", "running_term_counts", "dictionary_scores_stream"]
