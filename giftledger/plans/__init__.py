"""Whole jobs: the ordered daily run, its run log, and the registered queries."""
