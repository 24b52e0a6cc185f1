"""Fare analytics over city taxi trips, built from Spark DataFrame operators."""

from farescope.functions.names import sanitize_columns, unify_columns
from farescope.operators.clean import clean_trips, odd_date_trips, reject_audit
from farescope.operators.files import (
    expected_files,
    file_state,
    loadable_files,
    pending_files,
    quick_completeness,
    register_files,
)
from farescope.operators.holidays import flag_holidays, holiday_calendar
from farescope.operators.lookup import lookup_rates
from farescope.operators.overlay import crossing_map, overlap_map, polygon_area
from farescope.operators.rates import build_rates
from farescope.operators.spatial import (
    add_named_area,
    geo_to_zone,
    geo_unmatched,
    index_zones,
    zone_cells,
    zone_of_point,
)
from farescope.plans.refresh import run_pipeline
from farescope.session import build_session
from farescope.sources.geometry import load_geometry, reproject
from farescope.sources.trips_csv import list_trip_files, read_trip_files, read_trips_csv
from farescope.streaming.ingest import ingest_new_files

__all__ = [
    "add_named_area",
    "build_rates",
    "build_session",
    "clean_trips",
    "crossing_map",
    "expected_files",
    "file_state",
    "flag_holidays",
    "geo_to_zone",
    "geo_unmatched",
    "holiday_calendar",
    "index_zones",
    "ingest_new_files",
    "list_trip_files",
    "load_geometry",
    "loadable_files",
    "lookup_rates",
    "odd_date_trips",
    "overlap_map",
    "pending_files",
    "polygon_area",
    "quick_completeness",
    "read_trip_files",
    "read_trips_csv",
    "register_files",
    "reject_audit",
    "reproject",
    "run_pipeline",
    "sanitize_columns",
    "unify_columns",
    "zone_cells",
    "zone_of_point",
]
