"""Registered queries and their SQL oracles on the driver's tables."""
