"""Named analytics: each is a plan over the log tables."""
