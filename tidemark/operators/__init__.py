"""Operators over DataFrames: bounds, order, pages, checks, control tables and schemas."""
