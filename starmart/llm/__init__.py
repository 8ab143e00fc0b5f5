"""Training-data operators: deduplication, filtering, extraction and mixing.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; ``queries.py`` applies each to its whole table.
"""
