"""Periodic reports of many sites, turned into checked analytics tables with Spark."""
