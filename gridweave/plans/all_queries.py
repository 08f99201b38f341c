"""Every registered query: importing this module registers them all."""

from __future__ import annotations

from gridweave.plans import registry, registry_elements, registry_geometry, registry_patch, registry_topology  # noqa: F401
from gridweave.plans.registry import ORACLE_SQL, QUERIES, flagship  # noqa: F401
