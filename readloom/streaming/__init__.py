"""Structured Streaming forms of operators (an extension: batch operators do not need them)."""
