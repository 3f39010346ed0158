"""Arguments of a run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from geotally.fixed_values import PROJECTED_STATIONS, SRID_UTM17
from geotally.functions.text import split_list
from geotally.operators.forecast import ForecastSettings
from geotally.sources.quarantine import ErrorBudget

DATASETS = ("air", "forecasts", "traffic_volume", "geo_names", "intersections")
LAYERS = ("markers", "heat", "frames", "charts")


@dataclass(frozen=True)
class JobSettings:
    """What to stage, where tables go and which parts run.

    landing: folder of each dataset in ``DATASETS``; table_root: shared folder of the tables;
    export_folder: where to write text copies (none by default); create_tables off reads the
    tables of an earlier run; error_budget: set faulty lines of delimited files aside up to that share
    instead of stopping at the first.
    """

    landing: Mapping[str, str]
    table_root: str
    as_of: datetime
    links: Mapping[str, str] = field(default_factory=dict)
    stage_schema: str = "stage"
    public_schema: str = "public"
    stations: tuple[str, ...] = PROJECTED_STATIONS
    point_label: int = SRID_UTM17
    create_tables: bool = True
    run_forecast: bool = True
    forecast: ForecastSettings = field(default_factory=ForecastSettings)
    layers: tuple[str, ...] = LAYERS
    export_folder: str | None = None
    error_budget: ErrorBudget | None = None

    def __post_init__(self) -> None:
        if isinstance(self.layers, str):
            object.__setattr__(self, "layers", tuple(split_list(self.layers.lower())))
        unknown = set(self.layers) - set(LAYERS)
        if unknown:
            raise ValueError(f"layers are {', '.join(LAYERS)}; not {', '.join(sorted(unknown))}")
        missing = set(DATASETS) - set(self.landing)
        if self.create_tables and missing:
            raise ValueError(f"no landing folder for {', '.join(sorted(missing))}")
