"""Rasters by area, where a raster library is installed.

The statistics themselves are relational (``operators.zonal``) over rows
(geoid, year, value, frac). Making those rows from files needs rasterio and
shapely; without them land the coverage table by other means.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

try:
    import rasterio
    from rasterio import features, windows
    from shapely import wkb
except ImportError:
    rasterio = None

OVERSAMPLE = 8


def is_tiff(head: bytes) -> bool:
    """Whether a download begins like a TIFF file and not like an error page."""
    return head[:4] in (b"II*\x00", b"MM\x00*", b"II+\x00", b"MM\x00+")


def zipped_path(outer: str, inner: str, name: str) -> str:
    """The path by which a raster inside nested archives is read without unpacking."""
    return f"/vsizip/{{/vsizip/{{{outer}}}/{inner}}}/{name}"


def coverage_rows(shapes: DataFrame, files: dict[int, str]) -> DataFrame:
    """Rows (geoid, year, value, frac) from shapes (geoid, wkb) in the rasters' projection; fractions by oversampling."""
    if rasterio is None:
        raise RuntimeError("rasterio and shapely are not installed; land a coverage table instead")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                shape = wkb.loads(bytes(row.wkb))
                for year, path in files.items():
                    with rasterio.open(path) as src:
                        window = windows.from_bounds(*shape.bounds, src.transform).round_offsets().round_lengths("ceil")
                        data = src.read(1, window=window, masked=True)
                        fine = src.window_transform(window) * rasterio.Affine.scale(1 / OVERSAMPLE)
                        inside = features.rasterize([shape], (data.shape[0] * OVERSAMPLE, data.shape[1] * OVERSAMPLE), transform=fine)
                        frac = inside.reshape(data.shape[0], OVERSAMPLE, data.shape[1], OVERSAMPLE).mean(axis=(1, 3))
                        keep = (frac > 0) & ~data.mask
                        yield pd.DataFrame({"geoid": row.geoid, "year": year, "value": data.data[keep].astype(float), "frac": frac[keep]})

    return shapes.select("geoid", "wkb").mapInPandas(run, "geoid string, year int, value double, frac double")
