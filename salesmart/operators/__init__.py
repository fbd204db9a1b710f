"""Operators of the sales mart, each a DataFrame -> DataFrame plan fragment."""
