"""Operators over observations, metric series, runs, alerts and logs."""
