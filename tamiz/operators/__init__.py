"""DataFrame transforms: profiling, standardisation, duplicates, expectations."""
