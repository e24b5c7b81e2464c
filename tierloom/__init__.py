"""Layered (bronze, silver, gold) tables on plain open-source Spark."""
