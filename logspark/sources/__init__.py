"""Reading, decoding, shaping, storing, publishing and generating logs."""
