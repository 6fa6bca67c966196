"""DataFrame-to-DataFrame operators: gather, threads, assess, rank, review."""
