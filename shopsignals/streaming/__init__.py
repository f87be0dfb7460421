"""shopsignals.streaming."""
