"""Whole plans: the change-event pipeline, the derived log and the registered queries."""
