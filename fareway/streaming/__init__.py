"""Operators that run unchanged on a batch and on a stream."""
