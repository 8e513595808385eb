"""Readers that give batch or streaming DataFrames."""
