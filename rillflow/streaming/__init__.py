"""Streams: the landing folder."""
