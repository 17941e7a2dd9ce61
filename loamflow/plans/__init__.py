"""Run plans: the spec runner and the registered queries."""
