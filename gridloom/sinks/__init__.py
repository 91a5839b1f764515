"""Sinks: appended result tables and saved models."""
