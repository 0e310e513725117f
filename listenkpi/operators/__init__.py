"""Relational operators of the KPI job: cleaning, join, aggregation, ranking, full jobs."""
