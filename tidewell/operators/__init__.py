"""Governance operators: exclude, normalise, impute, flag, profile, degrade."""
