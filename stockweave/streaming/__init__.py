"""Structured Streaming forms of order intake and monthly sales."""
