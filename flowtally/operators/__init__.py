"""DataFrame-to-DataFrame operators: decode, derive, look up, report."""
