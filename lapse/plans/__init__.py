"""Composite jobs: dataset creation, training runs, evaluation, named queries."""
