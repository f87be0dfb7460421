"""shopsignals.operators."""
