"""Relational operators over support data; each takes and returns DataFrames."""
