"""Layered models: staging, core, mart and analytic, plus the ad-hoc reports."""
