"""Composed jobs and plan inspection."""

from . import jobs
from .inspect import count_exchanges, physical_plan, plan_text, pushed_filters, read_schemas
from .jobs import (
    clean_airports,
    clean_carriers,
    clean_flights,
    clean_planes,
    clean_variables,
    flights_audit_trail,
    flights_job,
    land,
    lookup_job,
    planes_audit_trail,
)

__all__ = [
    "clean_airports",
    "clean_carriers",
    "clean_flights",
    "clean_planes",
    "clean_variables",
    "count_exchanges",
    "flights_audit_trail",
    "flights_job",
    "jobs",
    "land",
    "lookup_job",
    "physical_plan",
    "plan_text",
    "planes_audit_trail",
    "pushed_filters",
    "read_schemas",
]
