"""Sinks: rerun-safe partitioned writers and catalog table management."""
