"""Drawn cases for the build: each rule has a plot of its own, with lengths set just inside or outside the rule's gate.

Things are called by name; ids are dealt in the order of drawing. Metres are counted from a plot's corner.
"""

from __future__ import annotations

import json
import math

from gridweave.config import Gates
from gridweave.functions.geometry import EARTH_M

GATE = Gates()
CORNER = (14.0, 47.5)
PLOT = 12_000.0
DEGREE = EARTH_M * math.pi / 180
CONFIG = {
    "voltage_floor_kv": 60,
    "metric_crs": "EPSG:3035",
    "bboxes": [[47.0, 13.5, 49.5, 16.5]],
    "standard_voltages_kv": [60, 110, 150, 220, 320, 380],
    "layer_voltages_kv": [110, 150, 220, 380],
    "layer_min_spans": 1,
    "traction": {"enabled": True, "frequency_hz": 16.7, "grid_frequency_hz": 50.0, "frequency_tags": ["16.7"], "max_voltage_kv": 132, "operators": ["alpine rail"]},
}


class Sheet:
    """Elements by name."""

    def __init__(self) -> None:
        self.elements: list[dict] = []
        self.names: dict[str, str] = {}
        self.plot = -1

    def next_plot(self) -> None:
        self.plot += 1

    def degrees(self, points: list[tuple[float, float]]) -> list[list[float]]:
        x0, y0 = self.plot % 5 * PLOT, self.plot // 5 * PLOT
        scale = math.cos(math.radians(CORNER[1])) * DEGREE
        return [[round(CORNER[0] + (x0 + x) / scale, 7), round(CORNER[1] + (y0 + y) / DEGREE, 7)] for x, y in points]

    def _add(self, name: str, kind: str, **fields: object) -> str:
        number = 40_000 + 7 * len(self.elements)
        self.elements.append({"type": kind, "id": number, **fields})
        self.names[name] = f"{kind}/{number}"
        return self.names[name]

    def way(self, name: str, points: list[tuple[float, float]], tags: dict[str, str]) -> str:
        return self._add(name, "way", tags=tags, geometry=self.degrees(points))

    def line(self, name: str, kv: float, points: list[tuple[float, float]], **tags: str) -> str:
        return self.way(name, points, {"power": "line", "voltage": f"{kv * 1000:g}", "circuits": "1"} | tags)

    def yard(self, name: str, volts: str, west: float, south: float, size: float) -> str:
        e, n = west + size, south + size
        return self.way(name, [(west, south), (west, n), (e, n), (e, south), (west, south)], {"power": "substation", "voltage": volts, "name": name})

    def route(self, name: str, kv: float, members: list[tuple[str, list[tuple[float, float]]]]) -> str:
        rows = [{"type": "way", "ref": int(self.names[m].split("/")[1]), "role": "", "geometry": self.degrees(points)} for m, points in members]
        return self._add(name, "relation", tags={"route": "power", "voltage": f"{kv * 1000:g}", "circuits": "1"}, members=rows)


def drawn() -> Sheet:
    s = Sheet()
    # A corridor of two voltages on one way between two yards; an underground cable goes on where a line ends.
    s.next_plot()
    s.yard("Quarry", "380000;110000", 300, 300, 240)
    s.yard("Mill", "380000;110000", 8000, 300, 240)
    s.way("corridor", [(500, 420), (4000, 700), (8100, 420)], {"power": "line", "voltage": "380000;110000", "cables": "6;6"})
    s.way("buried", [(420, 300), (420, -900)], {"power": "cable", "location": "underground", "voltage": "110000", "circuits": "1"})
    s.line("overhead", 110, [(420, -900), (420, -2800)])
    s.way("steel", [(420, 4000), (2000, 4000)], {"power": "line", "voltage": "40000"})
    # Three ways in a row, of which the middle one is drawn backwards; a fold-back that must stay apart.
    s.next_plot()
    s.line("row_a", 220, [(0, 0), (1500, 100)])
    s.line("row_b", 220, [(3100, 200), (1500, 100)])
    s.line("row_c", 220, [(3100, 200), (5000, 200)])
    s.line("fold_a", 150, [(0, 3000), (2500, 3000)])
    s.line("fold_b", 150, [(0, 3000), (2400, 3300)])
    # A spur that ends just inside the reach of a line's flank, and one just outside it.
    s.next_plot()
    near, far = GATE.junction_tol * 0.6, GATE.junction_ext * 1.5
    s.line("flank", 110, [(0, 0), (6000, 0)])
    s.line("spur", 110, [(2000, near), (2000, 2200)])
    s.line("aloof", 110, [(4500, far), (4500, 2600)])
    # Gaps between ends that face each other: closed, bridged, left open.
    s.next_plot()
    for k, (name, gap) in enumerate((("closed", GATE.ee_move_max * 0.7), ("bridged", (GATE.ee_move_max + GATE.ee_tol_free) / 2), ("open", GATE.ee_tol_free * 2.2))):
        y = 2500.0 * k
        s.line(f"{name}_a", 150, [(0, y), (2000, y)])
        s.line(f"{name}_b", 150, [(2000 + gap, y), (4300 + gap, y)])
    # Railway power by tag and by owner, which meet the public grid in a point.
    s.next_plot()
    s.line("rail_tagged", 110, [(0, 0), (3000, 0)], frequency="16.7")
    s.line("rail_owned", 110, [(0, 2500), (2800, 2500)], operator="Alpine Rail")
    s.line("beside_rail", 110, [(3000, 0), (3000, 1800)], frequency="50")
    s.way("direct", [(0, 6000), (4000, 6200), (9000, 6000)], {"power": "cable", "voltage": "320000", "frequency": "0", "name": "Deep link"})
    s.line("planned", 380, [(0, 8000), (5000, 8000)], construction="yes")
    # Footprints just within and just beyond reach of each other.
    s.next_plot()
    within, beyond = GATE.site_merge * 0.8, GATE.site_merge * 1.6
    s.yard("North yard", "150000", 0, 0, 120)
    s.yard("Twin yard", "150000", 120 + within, 0, 90)
    s.yard("Lone yard", "150000", 210 + within + beyond, 0, 90)
    # Conductors around a yard: two that share an anchored end outside the fence, one that overshoots, one that stays inside.
    s.next_plot()
    s.yard("Gate yard", "220000", 5000, 5000, 200)
    outside = 5000 - GATE.site_fence * 3
    s.line("entry", 220, [(outside, 5100), (5100, 5100)])
    s.line("from_west", 220, [(1000, 5100), (outside, 5100)])
    s.line("from_south", 220, [(1500, 2000), (outside - 60, 4800), (outside, 5100)])
    s.line("stub", 220, [(5150, 5150), (5200 + GATE.free_end_min * 1.6, 5150)])
    s.line("bus_bar", 220, [(5040, 5040), (5160, 5040)])
    # A relation whose ways join, and one whose ways do not.
    s.next_plot()
    first, second = [(0, 0), (1800, 0)], [(1800, 0), (4200, 0)]
    s.line("joint_a", 220, first)
    s.line("joint_b", 220, second)
    s.route("joint", 220, [("joint_a", first), ("joint_b", second)])
    one, two = [(0, 3000), (1200, 3000)], [(2600, 3000), (4000, 3000)]
    s.line("torn_a", 110, one)
    s.line("torn_b", 110, two)
    s.route("torn", 110, [("torn_a", one), ("torn_b", two)])
    # A side loop whose ends both fall onto one place of a line: it is swept, and the line made whole again.
    s.next_plot()
    lift = GATE.junction_tol * 0.5
    s.line("whole", 150, [(0, 0), (2600, 0), (5000, 0)])
    s.line("loop", 150, [(2600, lift), (2570, 140), (2640, 140), (2615, lift)])
    return s


def write(folder: str) -> Sheet:
    sheet = drawn()
    with open(f"{folder}/cases.ndjson", "w") as out:
        out.writelines(json.dumps(e) + "\n" for e in sheet.elements)
    return sheet
