"""Tenant data movement on Spark: plan, bulk load, replicate, verify."""

from tenantferry.operators.keyed_target import KeyedTarget
from tenantferry.plans.migrate import migrate
from tenantferry.plans.planning import Plan, plan
from tenantferry.plans.verification import isolation_report, verdict, verify
from tenantferry.specs import TableSpec
from tenantferry.streaming.replicate import replicate

__all__ = [
    "KeyedTarget", "Plan", "TableSpec", "isolation_report", "migrate", "plan",
    "replicate", "verdict", "verify",
]
