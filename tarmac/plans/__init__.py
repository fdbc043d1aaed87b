"""Runnable queries over the driver tables, each with its independent SQL."""
