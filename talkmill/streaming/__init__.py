"""Incremental (file-stream) form of the generation plan."""
