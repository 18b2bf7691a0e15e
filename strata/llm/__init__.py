"""Training-data operators: thirteen corpus operators, each in a module of its own, and their queries (registry)."""
