"""Readers for the input tables and the relations derived from them."""
