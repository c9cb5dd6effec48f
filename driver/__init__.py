"""The registered queries: logistics tables derived from the given ones, and their SQL twins."""
