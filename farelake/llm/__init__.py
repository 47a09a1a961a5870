"""Training-data operators: dedup, tokens, extraction, packing, search, sharding.

Nothing else in the library imports this subpackage. Each operator is one
module with a general interface; ``queries`` derives the registered queries.
"""
