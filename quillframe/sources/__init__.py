"""Readers and writers of the text formats that records come in."""
