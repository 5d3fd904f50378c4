"""Composite jobs: cross-validation protocols, strategy comparison, reports."""
