"""DataFrame operators over the log tables."""
