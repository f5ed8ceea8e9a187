"""Role mapping onto the test tables and the registry of queries + oracles."""
