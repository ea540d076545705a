"""Readers, writers and the bindings that shape given tables into posts."""
