"""Cleaning, profiling, surrogate keys and size-checked lookup joins."""
