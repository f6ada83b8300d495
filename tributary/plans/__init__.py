"""Marts and query plans built from the operators."""
