"""SQL fragments for the DuckDB oracle texts (same fixed values as the engine)."""

from __future__ import annotations

from ..operators.tokens import OTHER, SENTENCE, STOPWORDS_EN, WORD


def lit_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP_EN_SQL = lit_list(STOPWORDS_EN)
WORD_SQL = WORD.replace("'", "''")
TOKEN_SQL = f"{WORD}|{OTHER}".replace("'", "''")
SENT_SQL = SENTENCE.replace("'", "''")


def tokens_cte(source: str, keys: str = "doc_id", text: str = "text", name: str = "tok") -> str:
    """Long tokens (keys…, pos, term), lower case, 1-based positions."""
    return (f"{name} AS (SELECT {keys}, unnest(generate_series(1, len(_a))) AS pos, unnest(_a) AS term "
            f"FROM (SELECT {keys}, regexp_extract_all(lower({text}), '{WORD_SQL}') AS _a FROM {source}))")
