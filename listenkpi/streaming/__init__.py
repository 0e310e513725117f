"""Incremental KPI maintenance over a folder of arriving play files (Structured Streaming)."""
