"""The queries of ``__spark_entry__`` and their SQL oracles over the given tables."""
