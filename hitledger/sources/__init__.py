"""Readers: raw lines, exported files, crawler lists, listings, notifications."""
