"""Whole tables and views put together from the operators."""
