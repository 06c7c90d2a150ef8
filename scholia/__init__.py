"""Scholarly-corpus analytics on Spark."""
