"""Dimensions, facts, KPIs and the jobs that write them."""
