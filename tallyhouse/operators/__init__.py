"""Relational, privacy, history and serving operators: DataFrame in, DataFrame out."""
