"""Table transformations and aggregates, one module per family."""
