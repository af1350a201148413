"""Readers and writers."""

from .files import (read_csv, read_jsonl, write_json, read_json, read_vectors, bad_vector_lines,
                    save_table, load_table, with_row_id, profile)
from .tables import TABLES, table, tables

__all__ = ["read_csv", "read_jsonl", "write_json", "read_json", "read_vectors", "bad_vector_lines",
           "save_table", "load_table", "with_row_id", "profile", "TABLES", "table", "tables"]
