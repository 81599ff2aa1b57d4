"""Summaries kept up to date as readings arrive."""
