"""Retail replenishment, KPI and change-capture jobs written as Spark plans."""
