"""Workloads as DataFrame plans (DataFrame in, DataFrame out; nothing collected)."""
