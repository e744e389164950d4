"""Readers that turn captured feeds, pages, posts and config files into tables."""
