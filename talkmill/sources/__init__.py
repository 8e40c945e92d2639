"""Corpus scan, numbering, inspection tables and sinks."""
