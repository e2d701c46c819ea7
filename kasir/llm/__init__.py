"""Training-data operators: each module holds one operator with its own
general interface; ``kasir.llm.queries`` binds them to the sample tables."""
