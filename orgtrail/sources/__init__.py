"""Reading the registry, reading key lists, writing reports."""
