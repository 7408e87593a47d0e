"""Readers and writers of sequence, alignment, annotation and table files."""
