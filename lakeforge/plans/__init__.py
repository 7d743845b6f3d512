"""Registered queries; importing this fills the registry."""

from lakeforge.plans import governance, landing, linking, quality, streams  # noqa: F401
from lakeforge.plans.registry import ORACLES, QUERIES  # noqa: F401
