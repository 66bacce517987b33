"""Queries over the benchmark tables, with equivalent SQL to check them against."""
