"""shopsignals.plans."""
