"""DataFrame-level operators composed from Spark built-ins."""
