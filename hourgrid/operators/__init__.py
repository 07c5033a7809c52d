"""DataFrame-to-DataFrame operators on long tables."""
