"""Operators, one module per family; each takes DataFrames and returns one."""
