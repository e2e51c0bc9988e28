"""Queries of the training-data operators, by name, with SQL where SQL can state them."""

from __future__ import annotations

from quayload.plans.registry import Query, Runner

LLM_REGISTRY: dict[str, Query] = {}


def llm_query(name: str, oracle: str | None = None):
    """Register a query of this subpackage under a name."""

    def add(run: Runner) -> Runner:
        if name in LLM_REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        LLM_REGISTRY[name] = Query(name, run, oracle)
        return run

    return add
