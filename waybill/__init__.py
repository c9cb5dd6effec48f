"""Delivery-route operations analytics on Spark SQL."""

from waybill.operators.scope import ReportScope
from waybill.plans.registry import run_metric
from waybill.sources.tables import Tables

__all__ = ["ReportScope", "Tables", "run_metric"]
