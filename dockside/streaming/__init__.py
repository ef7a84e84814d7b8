"""Micro-batch upkeep."""
