"""Training-data operators: filters, near-duplicate detection, packing, search.

Each module holds one operator with its own general interface; ``queries``
holds the registered queries and their SQL. Nothing else in the library
imports this package.
"""
