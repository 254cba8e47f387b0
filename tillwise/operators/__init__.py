"""DataFrame-to-DataFrame analytics over sales facts."""
