"""Registered queries with their equivalent SQL, over the driver's tables."""
