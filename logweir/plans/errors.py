"""Errors raised while a plan is being decided, before any Spark job."""

from __future__ import annotations


class PlanError(ValueError):
    """The request cannot be turned into a plan."""


class UnknownField(PlanError):
    """A name outside a table whose columns are all known."""


class NoExactView(PlanError):
    """No view groups by this dimension."""

    def __init__(self, dimension: str, population: str, supported: list[str], why: str = ""):
        self.dimension = dimension
        self.population = population
        self.supported = supported
        listed = ", ".join(supported) if supported else "none"
        super().__init__(
            f"no view groups {population} by '{dimension}' exactly. {why}"
            f"Exact dimensions: {listed}. Use a breakdown over ['{dimension}'] instead."
        )


class WrongPopulation(NoExactView):
    """A view groups by this dimension, but over other logs."""

    def __init__(self, dimension: str, population: str, view: str, serves: str, supported: list[str]):
        self.view = view
        self.serves = serves
        super().__init__(
            dimension, population, supported, f"The view '{view}' reads {serves} logs. "
        )
