"""Operators: row parsing, splits, joins, metrics, trainers and scoring."""
