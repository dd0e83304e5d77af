"""Table-level operators: per-key picks, running numbers, allocation, lookups, changes."""
