"""Grid cell arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrid.functions.numeric import as_col
from tripgrid.profiles import CellCentres, Grid


def cell_index(coordinate, origin: float, size: float) -> Column:
    """Cells between ``origin`` and ``coordinate``, truncated toward zero."""
    return ((as_col(coordinate) - F.lit(origin)) / F.lit(size)).cast("int")


def cell_id(lat_index, lon_index, prefix: str | None = "cell") -> Column:
    parts = [as_col(lat_index), as_col(lon_index)]
    return F.concat_ws("_", *([F.lit(prefix)] if prefix else []), *parts)


def with_cell(df: DataFrame, grid: Grid, lat="pickup_lat", lon="pickup_lon") -> DataFrame:
    """Add the index columns, ``cell_id`` and, where the grid asks for them, cell centres."""
    df = df.withColumns({
        grid.lat_column: cell_index(lat, grid.origin_lat, grid.size),
        grid.lon_column: cell_index(lon, grid.origin_lon, grid.size),
    })
    added = {"cell_id": cell_id(grid.lat_column, grid.lon_column, grid.prefix)}
    if grid.with_centres:
        added["cell_center_lat"] = (F.col(grid.lat_column) + 0.5) * grid.size + grid.origin_lat
        added["cell_center_lon"] = (F.col(grid.lon_column) + 0.5) * grid.size + grid.origin_lon
    return df.withColumns(added)


def centre_coordinates(lat_index, lon_index, centres: CellCentres) -> tuple[Column, Column]:
    """Latitude and longitude of a cell, by the affine map of ``centres``."""
    return (
        F.lit(centres.lat_origin) + (as_col(lat_index) + centres.offset) * centres.lat_step,
        F.lit(centres.lon_origin) + (as_col(lon_index) + centres.offset) * centres.lon_step,
    )


def parse_cell_id(cell) -> tuple[Column, Column]:
    """Indexes written in the last two parts of a cell id; null when they are no integers."""
    parts = F.split(as_col(cell), "_")
    index = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("int")
    return index(-2), index(-1)
