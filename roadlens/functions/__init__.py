"""Roadlens subpackage."""
