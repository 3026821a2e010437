"""Fitted stages, model search and run tables."""
