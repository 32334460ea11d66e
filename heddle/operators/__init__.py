"""Operators: DataFrames in, DataFrames out; configuration is passed explicitly and every "now" is a parameter."""
