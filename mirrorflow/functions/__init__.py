"""Column-level helpers: missing-value semantics, code lists, keys."""
