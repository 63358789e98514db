"""Composite jobs and the derivation of job inputs from the test tables."""
