"""Postings that arrive in a folder."""
