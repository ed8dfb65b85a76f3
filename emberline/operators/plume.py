"""Plume operators: flux, centroids, ratios, and the detector from chips to quantified plumes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels
from .kernels import Transmittance

#: Pixel area, molar mass and volume, the noise of one pixel in ppb, wind-to-speed line and its errors.
AREA, MOLAR_MASS, MOLAR_VOLUME, NOISE, SLOPE, OFFSET, SLOPE_ERROR, OFFSET_ERROR = 100.0, 0.01604, 22.4, 205.64270005117675, 0.33, 0.45, 0.01, 0.01
_MASS = AREA * 1000.0 * MOLAR_MASS / (1e6 * MOLAR_VOLUME)


def flux_columns(total: Column, pixels: Column, wind: Column) -> tuple[Column, Column]:
    """Flux in kg/h and its deviation from the clamped enhancement sum (ppm m), the pixel count and the wind speed."""
    n = F.when(pixels > 0, pixels)
    mass, length, speed = total * _MASS, F.sqrt(n * AREA), SLOPE * wind + OFFSET
    noise = NOISE * 8 * F.sqrt(n) * _MASS
    spread = (SLOPE**2 + SLOPE_ERROR**2) * wind * wind * 1.25 - F.pow(SLOPE * wind, 2) + OFFSET_ERROR**2
    variance = spread * noise * noise + spread * mass * mass + noise * noise * speed * speed
    flux = F.when(total > 0, 3600.0 * speed * mass / length).otherwise(0.0)
    return F.when(pixels > 0, flux).otherwise(0.0), F.when(pixels > 0, 3600.0 / length * F.sqrt(F.greatest(variance, F.lit(0.0)))).otherwise(0.0)


def fluxes(pixels: DataFrame, by: list[str]) -> DataFrame:
    """(by, pixels, flux_kg_h, flux_std) of plume pixels with ``enhancement`` (ppb) and ``wind_speed``."""
    clamped = F.least(F.greatest("enhancement", F.lit(-600.0)), F.lit(100000.0)) * 8
    parts = pixels.groupBy(*by).agg(F.sum(clamped).alias("total"), F.count("*").alias("pixels"), F.max("wind_speed").alias("wind"))
    flux, std = flux_columns(F.col("total"), F.col("pixels"), F.col("wind"))
    return parts.select(*by, "pixels", flux.alias("flux_kg_h"), std.alias("flux_std"))


def centroids(pixels: DataFrame, by: list[str], threshold: float = 0.5) -> DataFrame:
    """(by, row, col, max_p): middle of a plume weighted by probability above the threshold, pixel centres at halves."""
    w = F.col("p") - threshold
    return pixels.groupBy(*by).agg((F.sum(w * (F.col("r") + 0.5)) / F.sum(w)).alias("row"), (F.sum(w * (F.col("c") + 0.5)) / F.sum(w)).alias("col"), F.max("p").alias("max_p"))


def gate(clear_percent: Column, zero_share: Column, background: Column) -> Column:
    """Status of a scene, the first that applies."""
    return F.when(clear_percent < 50, "cloudy").when(zero_share > 0.5, "out_of_swath").when(background.isNull(), "no_background").otherwise("ok")


def masked(probability: Column, valid: Column) -> Column:
    """Probabilities with 0 where the pixel is not valid."""
    return F.zip_with(probability, valid, lambda p, v: F.when(v, p).otherwise(0.0))


Predictor = Callable[[np.ndarray], np.ndarray]


def onnx_predictor(path: str, digest: str | None = None) -> Callable[[], Predictor]:
    """A factory of predictors (channels x rows x columns to rows x columns) from a model file, checked against its SHA-256.

    The session is made where the factory is called, once a worker.
    """

    def make() -> Predictor:
        import hashlib

        import onnxruntime

        with open(path, "rb") as f:
            data = f.read()
        if digest and hashlib.sha256(data).hexdigest() != digest:
            raise ValueError(f"{path} is not the model it should be")
        session = onnxruntime.InferenceSession(data, providers=["CPUExecutionProvider"])
        name = session.get_inputs()[0].name

        def predict(x: np.ndarray) -> np.ndarray:
            h, w = x.shape[1:]
            return session.run(None, {name: kernels.pad_to(x)[None].astype(np.float32)})[0].reshape(-1, h + -h % 32, w + -w % 32)[0, :h, :w]

        return predict

    return make


#: Classes of the cloud network of which only the first is clear.
CLOUD_NETWORK_CLASSES = 4
PLUME = "id string, status string, scene_score double, plume int, pixels int, flux_kg_h double, flux_std double, max_p double, row double, col double"


def detect_plumes(pairs: DataFrame, predictor: Callable[[], Predictor], tables: dict[str, Transmittance], least: int = 100) -> DataFrame:
    """Quantified plumes of chip pairs, a row a plume; a pair without plumes gives one row with a null plume.

    Pairs have id, satellite, width, height, target and background (13 channels of flattened pixels), valid,
    wind_u, wind_v, sun_zenith, view_zenith, clear_percent; a null background is a status of its own.  Each pair is
    one row, so memory is a batch of chips.  ``predictor`` makes the network in the worker.
    """
    bands = [1, 2, 3, 7, 11, 12]

    def one(row, predict: Predictor) -> list[tuple]:
        shape = (int(row.height), int(row.width))
        target = np.asarray(row.target, np.float32).reshape(13, *shape)
        blank = (row.id,)
        if row.clear_percent < 50:
            return [(*blank, "cloudy", *[None] * 8)]
        if (target == 0).sum() * 2 > target.size:
            return [(*blank, "out_of_swath", *[None] * 8)]
        if row.background is None:
            return [(*blank, "no_background", *[None] * 8)]
        back = np.asarray(row.background, np.float32).reshape(13, *shape)
        valid = np.asarray(row.valid, bool).reshape(shape)
        near, _ = kernels.align(target[bands], back[bands], (3, 2, 1))
        p = np.where(valid, predict(kernels.network_input(target[bands], near, valid, (row.wind_u, row.wind_v))), 0).astype(np.float32)
        labels = kernels.plumes(p, 0.5, least + 1)  # a plume has more than the least number of pixels
        found = kernels.scene_score(p, least)
        if not labels.any():
            return [(*blank, "ok", found, *[None] * 7)]
        whole, _ = kernels.align(target, back, (3, 2, 1))
        ratio = kernels.retrieval_ratio(target, whole, valid, labels > 0, 11, 12)
        gas = kernels.enhancement(ratio, row.sun_zenith, row.view_zenith, tables[row.satellite])
        out = []
        for k in range(1, labels.max() + 1):
            r, c = np.nonzero(labels == k)
            w = (p[r, c] - np.float32(0.5)).astype(float)
            rate, std = flux(gas[r, c], float(np.hypot(row.wind_u, row.wind_v)))
            out.append((*blank, "ok", found, k, len(r), rate, std, float(p[r, c].max()), float((w * (r + 0.5)).sum() / w.sum()), float((w * (c + 0.5)).sum() / w.sum())))
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = predictor()
        for frame in frames:
            yield pd.DataFrame([x for row in frame.itertuples(index=False) for x in one(row, predict)], columns=[x.split()[0] for x in PLUME.split(", ")])

    return pairs.mapInPandas(run, PLUME)


def flux(enhancement: np.ndarray, wind: float) -> tuple[float, float]:
    """The same flux on an array of plume pixels."""
    n = len(enhancement)
    if not n:
        return 0.0, 0.0
    total = float((np.clip(enhancement, -600, 100000) * 8).sum())
    mass, length, speed, noise = total * _MASS, np.sqrt(n * AREA), SLOPE * wind + OFFSET, NOISE * 8 * np.sqrt(n) * _MASS
    spread = (SLOPE**2 + SLOPE_ERROR**2) * wind**2 * 1.25 - (SLOPE * wind) ** 2 + OFFSET_ERROR**2
    std = 3600 / length * np.sqrt(max(spread * noise**2 + spread * mass**2 + noise**2 * speed**2, 0.0))
    return (3600 * speed * mass / length if total > 0 else 0.0), float(std)


def methane(pixels: DataFrame, tables: dict[str, Transmittance]) -> DataFrame:
    """Adds ``enhancement`` to rows with satellite, ratio, sun_zenith and view_zenith; one spline a distinct geometry of a batch."""

    @F.pandas_udf("double")
    def convert(satellite: pd.Series, ratio: pd.Series, sun: pd.Series, view: pd.Series) -> pd.Series:
        out = pd.Series(np.zeros(len(ratio)))
        keys = pd.DataFrame({"s": satellite, "a": sun, "b": view})
        for (s, a, b), at in keys.groupby(["s", "a", "b"]).indices.items():
            out.iloc[at] = kernels.enhancement(ratio.iloc[at].to_numpy(), a, b, tables[s])
        return out

    return pixels.withColumn("enhancement", convert("satellite", "ratio", "sun_zenith", "view_zenith"))
