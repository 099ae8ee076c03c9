"""Test scaffolding: the profile corpus that Spark renders from the given tables."""
