"""Reading source files, and where batches, ledgers and results are kept."""
