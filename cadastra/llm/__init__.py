"""Training-data operators: scoring, mixing, de-duplication, archives, fingerprints, packing, chat.

Each module is one operator with its own general interface; ``queries`` holds the thin registered
queries. Nothing outside this package imports it.
"""
