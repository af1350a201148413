"""quire: text-as-data analytics on Spark DataFrames.

Every operator takes and returns DataFrames in long format
(``doc_id, pos, term`` for tokens, ``doc_id, term, n`` for a
document-feature table) so Catalyst plans the whole chain.
"""

__version__ = "0.1.0"
