"""Plan inspection helpers used by tests and the bench."""
