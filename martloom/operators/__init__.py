"""DataFrame operators: load windows, de-duplication, lookups, mart mutations."""
