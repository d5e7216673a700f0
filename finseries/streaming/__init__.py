"""Structured Streaming entry points.

The source system has no stream processing: its curation is a scheduled
batch that rewrites each table from every landed file.  The one streaming
job here is that same curation, triggered by file arrival.
"""
