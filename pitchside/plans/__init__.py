"""Composite plans: training (C2, C5), snapshots (C8), sinks (K1-K6), job."""
