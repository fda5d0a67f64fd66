"""Structured Streaming form of the year-to-date feed (monthly counts)."""
