"""Sources: SQL text, files, control tables and saved models."""
