"""Runnable batch jobs."""
