"""The registered queries: every operator applied to the given tables, with its SQL check."""
