"""Column functions: text standardisation and geography."""
