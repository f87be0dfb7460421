"""shopsignals.models."""
