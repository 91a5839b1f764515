"""Hyper-parameter grids and the texts that report them."""

from __future__ import annotations

from itertools import product


def grid_points(params: dict[str, str], keys: tuple[str, ...]) -> list[dict[str, str]]:
    """The product of the comma lists of ``keys``, first key outermost."""
    lists = [[v.strip() for v in params[k].split(",")] for k in keys]
    return [{**params, **dict(zip(keys, point))} for point in product(*lists)]


def point_message(index: int, shown: list[tuple[str, str]], metric: str, value: float) -> str:
    """``number: 0, <name>: <value>, ..., <metric>: <value>`` (fixed format)."""
    parts = [("number", str(index)), *shown, (metric, str(value))]
    return ", ".join(f"{name}: {text}" for name, text in parts)


def best_message(app_name: str, job_id: str, best: int, extreme: str, metric: str, value: float) -> str:
    """Fixed format."""
    return (f"In {app_name} job {job_id}, the best result is got by {best}-th group parameters, "
            f"and the {extreme} {metric} is {value}")
