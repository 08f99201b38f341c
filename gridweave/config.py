"""Parameters of a build, read from a mapping or a YAML-like file."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Traction:
    """Railway networks at their own frequency."""

    enabled: bool = False
    frequency_hz: float = 16.7
    frequency_tags: tuple[str, ...] = ("16.7", "16.67")
    max_voltage_kv: float = 132.0
    countries: tuple[str, ...] = ()
    operators: tuple[str, ...] = ()
    #: Short operator tokens must then equal a known one or start with it and a blank; long ones may contain it.
    strict_operator_tokens: bool = False


@dataclass(frozen=True)
class Gates:
    """Distances in metres unless named otherwise, cosines, shares and degrees."""

    site_merge: float = 150.0
    site_catchment: float = 250.0
    site_fence: float = 30.0
    free_end_min: float = 50.0
    bridge_outside_max: float = 50.0
    bridge_gap_max: float = 250.0
    junction_tol: float = 25.0
    junction_ext: float = 150.0
    ee_tol_free: float = 150.0
    ee_move_max: float = 50.0
    cos_continue_max: float = -0.5
    max_cluster: float = 600.0
    ext_max_cluster: float = 250.0
    junction_move_max: float = 50.0
    cross_component_merge: float = 300.0
    parallel_reject_deg: float = 25.0
    dc_max_converter: float = 10_000.0
    dc_far: float = 2_000.0
    length_retention: float = 0.999
    fragment_flag: int = 20
    long_connector: float = 1_000.0
    self_loop_keep_flag: float = 1_000.0
    proxy_tol_kv: float = 5.0
    outward_sample: float = 50.0
    cluster_pair_limit: int = 200


@dataclass(frozen=True)
class Config:
    """``voltage_floor_kv``, ``metric_crs`` and one of ``bboxes`` and ``areas`` have no default."""

    voltage_floor_kv: float
    metric_crs: str
    bboxes: tuple[tuple[float, float, float, float], ...] = ()
    areas: tuple[str, ...] = ()
    grid_frequency_hz: float = 50.0
    high_pass_kv: float = 100.0
    traction: Traction = field(default_factory=Traction)
    country_source: str = "none"
    country_polygons: str | None = None
    country_field: str = "ISO_A2"
    layer_voltages_kv: tuple[int, ...] = ()
    standard_voltages_kv: tuple[float, ...] = ()
    layer_min_spans: int = 50
    scope_bbox: tuple[float, float, float, float] | None = None
    dc_ratings_csv: str | None = None
    benchmark_csv: str | None = None
    force_dc_ids: tuple[str, ...] = ()
    chunk_degrees: float = 5.0
    merge_across_components: bool = False
    gates: Gates = field(default_factory=Gates)

    def __post_init__(self) -> None:
        if not self.bboxes and not self.areas:
            raise ValueError("one of bboxes and areas is required")
        if self.country_source not in ("none", "osm_tag", "polygons"):
            raise ValueError(f"unknown country_source {self.country_source!r}")
        if self.country_source == "polygons" and not self.country_polygons:
            raise ValueError("country_source polygons needs country_polygons")


def _frozen(value):  # noqa: ANN001, ANN202
    return tuple(map(_frozen, value)) if isinstance(value, list) else value


def from_mapping(data: dict) -> Config:
    """A Config from nested dicts and lists. Unknown keys are an error; ``traction.grid_frequency_hz`` is understood."""
    data = dict(data)
    traction = dict(data.pop("traction", {}) or {})
    if "grid_frequency_hz" in traction:
        data.setdefault("grid_frequency_hz", traction.pop("grid_frequency_hz"))
    missing = [k for k in ("voltage_floor_kv", "metric_crs") if data.get(k) is None]
    if missing:
        raise ValueError(f"missing: {', '.join(missing)}")
    gates = Gates(**data.pop("gates", {}))
    known = {f.name for f in fields(Config)}
    if extra := sorted(set(data) - known):
        raise ValueError(f"unknown: {', '.join(extra)}")
    plain = Traction(**{k: _frozen(v) for k, v in traction.items()})
    plain = replace(plain, frequency_tags=tuple(map(str, plain.frequency_tags)))
    return Config(**{k: _frozen(v) for k, v in data.items()}, traction=plain, gates=gates)


def load(path: str) -> Config:
    """A Config from a JSON file, or from a YAML file where the yaml module is installed."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        return from_mapping(json.loads(text))
    try:
        import yaml
    except ImportError as e:
        raise ValueError("reading YAML needs the yaml module; JSON needs nothing") from e
    return from_mapping(yaml.safe_load(text))
