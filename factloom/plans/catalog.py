"""Registered queries over the supplied tables, each with equivalent SQL."""

from . import flow_queries, fusion_queries, match_queries, record_queries, state_queries, text_queries

FLAGSHIP = "fusion_status_tristate"
PLANS = (fusion_queries, text_queries, flow_queries, record_queries, state_queries, match_queries)


def queries() -> dict:
    return {k: v for plan in PLANS for k, v in plan.Q.items()}


def oracle_sql() -> dict:
    return {k: v for plan in PLANS for k, v in plan.S.items() if v}
