"""Operators over annotated text graphs; every one takes and returns DataFrames."""
