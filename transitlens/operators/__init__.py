"""Operators on flat report DataFrames (batch and, where noted, streaming)."""
