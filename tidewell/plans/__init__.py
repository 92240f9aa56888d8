"""Governed views, derived tables, reports and calibration checks."""
