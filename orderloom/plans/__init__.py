"""Whole jobs: the item fact, its build run, and table loads."""
