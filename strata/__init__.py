"""Layered table building on Spark: clean, validate, deduplicate, model, measure."""
