"""Concrete plans: the hospital source configuration, sample logs on the
driver tables, and the registered query set."""
