"""Spark jobs for a video-streaming service: sources, cleaning, marts, queries, checks, models."""
