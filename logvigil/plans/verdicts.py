"""Registration of queries whose rows show what the classifier said."""

from __future__ import annotations

from collections.abc import Callable

from logvigil.plans.derived import alerts, checkable
from logvigil.plans.registry import query


def shown(name: str, check: str, masked: Callable | None = None, column: str = "predicted_attack_type"):
    """Register a query that shows what the classifier said, and beside it, as ``<name>_check``, its rows as SQL can check them.

    These have one mark for the verdicts of the classifier (:func:`derived.checkable`), or are what ``masked`` gives.
    """

    def register(fn):
        query(name)(fn)
        query(f"{name}_check", check)(masked or (lambda spark, sf: checkable(fn(spark, sf), alerts(spark, sf), column)))
        return fn

    return register
