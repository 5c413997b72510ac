"""The given tables seen through the package: contracts, queries and expected results."""
