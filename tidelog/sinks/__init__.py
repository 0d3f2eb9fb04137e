"""Record shaping, files, tables and delivery to injected transports."""
