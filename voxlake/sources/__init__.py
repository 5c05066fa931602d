"""Readers. Each returns a lazy DataFrame."""
