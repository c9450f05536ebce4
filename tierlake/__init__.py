"""Layered (bronze, silver, gold) warehouse jobs for food-delivery data on Spark."""

from tierlake.plans.warehouse import run_warehouse
from tierlake.sources.store import ConstraintViolation, TableStore

__all__ = ["ConstraintViolation", "TableStore", "run_warehouse"]
