"""Column functions: classification, value decoding, text and envelopes."""
