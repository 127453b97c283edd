"""Layered warehouse loading on Spark: ingest, cleanse, profile, version, densify, audit."""
