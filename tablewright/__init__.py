"""Curation of relational tables as Spark jobs: land, profile, keep the latest
rows, mask, join, check, repair and publish. Every operator takes and returns
DataFrames and leaves the physical plan to Catalyst and adaptive execution."""
