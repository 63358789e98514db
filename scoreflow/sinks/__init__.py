"""Sinks: lake writes, JDBC loads, load reports, metrics and artifacts."""
