"""DataFrame operators: sync, archives, catalog, vectors, text, retrieval, quality."""
