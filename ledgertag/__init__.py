"""Rule-driven tagging of two-sided accounting transactions, built on Spark."""

from ledgertag.config import CREDIT, DEBIT, Layout, Side
from ledgertag.plans.classify import classify
from ledgertag.plans.job import run_job

__all__ = ["CREDIT", "DEBIT", "Layout", "Side", "classify", "run_job"]
