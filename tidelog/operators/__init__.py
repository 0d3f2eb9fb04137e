"""DataFrame operators over change-event tables."""
