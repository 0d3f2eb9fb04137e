"""Change-log, record and configuration sources."""
