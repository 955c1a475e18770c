"""Base queries to read from and sinks to deliver to."""
