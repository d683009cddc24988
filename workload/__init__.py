"""Match data derived from the given tables, the registered queries and their oracles."""
