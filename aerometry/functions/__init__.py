"""Column functions: message and payload decoding, city assignment."""
