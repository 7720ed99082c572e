"""Composed plans: the star-schema build (lazy) and the write jobs (ingest, backfill,
rolling refresh, stations)."""
