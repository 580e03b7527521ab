"""DataFrame-to-DataFrame operators: cleaning, counting, aggregating, checking."""
