"""Column-level building blocks; every function returns a native Column."""
