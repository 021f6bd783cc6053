"""Structured Streaming runners over the plan functions of ``sparkmart.plans``."""
