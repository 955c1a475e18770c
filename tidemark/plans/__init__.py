"""Whole scans: bound, order, encode, check, publish, deliver, commit."""
