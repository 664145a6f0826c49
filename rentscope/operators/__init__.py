"""Relational operators over listing DataFrames (pure DataFrame -> DataFrame)."""
