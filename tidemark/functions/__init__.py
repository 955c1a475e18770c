"""Column expressions: JSON encoders, identities and strict conversions."""
