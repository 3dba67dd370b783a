"""DataFrame-to-DataFrame steps of the order pipeline."""
