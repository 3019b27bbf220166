"""Training-data operators: tokenising, packing, mixing, extraction, search, filtering, deduplication.

Each module holds one operator with its general interface; ``queries`` registers the
thin contract queries and their oracles. Nothing else in the package imports this
subpackage.
"""
