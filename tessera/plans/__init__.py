"""Bindings of tables to roles, and the stages of a linkage run."""
