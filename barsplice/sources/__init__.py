"""Readers and writers of sequencing formats."""
