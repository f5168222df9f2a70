"""Layered warehouse operators for Spark: table in, table out, planned by Catalyst."""
