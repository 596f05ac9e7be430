"""Streaming forms of the operators: watermarks, windows, keyed state, sinks."""
