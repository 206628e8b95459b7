"""Operators for building training data: archives, cleaning, deduplication, mixing and packing.

Nothing else in the library imports this package. Every operator takes DataFrames
and returns DataFrames; ``merchlens.llm.registry`` holds the registered queries.
"""
