"""shopsignals.functions."""
