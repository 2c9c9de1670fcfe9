"""Composed jobs: build, train, dashboard."""
