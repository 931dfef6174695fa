"""Composed jobs: table bindings, batch and incremental runs, dashboard queries."""
