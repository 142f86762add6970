"""DataFrame operators. Lazy unless the docstring says that a job runs."""
