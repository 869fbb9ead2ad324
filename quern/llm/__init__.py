"""Operators for text corpora at scale; nothing else in the library imports this subpackage."""
