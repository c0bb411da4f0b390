"""Operators for preparing training data at scale. Nothing outside this subpackage imports it."""
