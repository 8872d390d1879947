"""Whole jobs: curate reports, curate rules, plan demand, report load status."""
