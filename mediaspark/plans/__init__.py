"""Queries over the layers: saved queries, KPIs, live traffic, checks, models' tables, traces."""
