"""Registered queries: each operator over the given tables, with the same result in plain SQL where SQL can say it."""
