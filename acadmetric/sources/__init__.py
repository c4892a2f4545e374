"""Readers, writers and the logical views of the evaluation schema."""
