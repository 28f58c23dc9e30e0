"""The driver's test tables seen as retention data, with queries and oracle SQL."""
