"""Training-data operators: quality, tokens, dedup, search, mixing, packing, chat formatting.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers ``llm.registry`` only when the subpackage is present.
"""
