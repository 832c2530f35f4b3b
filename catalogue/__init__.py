"""Test tables derived from the driver's tables, and the queries registered on them."""
