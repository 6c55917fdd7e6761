"""Aggregation plans: base partials, the rollup catalogue, folding, upkeep."""
