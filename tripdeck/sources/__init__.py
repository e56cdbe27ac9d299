"""Sources: declared schemas, monthly-file and lookup readers, test-data views."""
