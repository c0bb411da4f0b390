"""Readers of saved exports and writers of tables."""
