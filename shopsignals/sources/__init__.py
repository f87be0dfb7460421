"""shopsignals.sources."""
