"""DataFrame transforms: index building, evidence, retrieval, decisions, batches."""
