"""Stage composition: the pipeline, the registered queries and their oracles."""
