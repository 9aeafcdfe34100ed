"""Reusable steps from DataFrame to DataFrame."""
