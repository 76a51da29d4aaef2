"""All registered queries."""

from __future__ import annotations

from lossgrid.plans import category_plans, drift_plans, impairment_plans, metric_plans, model_plans, preparation_plans, risk_plans
from lossgrid.plans.registry import Query

PARTS = (impairment_plans, preparation_plans, category_plans, metric_plans, drift_plans, risk_plans, model_plans)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for part in PARTS:
        twice = found.keys() & part.QUERIES.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        found.update(part.QUERIES)
    return found
