"""Dense raster kernels in numpy; no Spark here.  Arrays are rows x columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK, OVERLAP = 256, 10
#: Mask classes that count as cloud (shadow, medium, high, cirrus).
CLOUD_CLASSES = (3, 8, 9, 10)


@dataclass(frozen=True)
class Thresholds:
    b12_min: float = 0.30
    b11_min: float = 0.20
    peak_b12_min: float = 0.50
    contrast_ratio: float = 3.0
    background_floor: float = 0.15
    peakedness_min: float = 1.15
    saturation: float = 1.0
    hot_floor: float = 0.50
    max_pixels: float = 80
    large_pixels: float = 30
    large_b12_min: float = 0.70
    warm_fraction: float = 0.5
    warm_max_pixels: float = 100
    single_pixel_min: float = 0.65
    max_cloud_local: float = 0.75
    cloud_free_thresh: float = 0.30


def reflectance(dn: np.ndarray, offset: float = -1000.0, quantification: float = 10000.0) -> np.ndarray:
    """Digital numbers as reflectance; 0 is no data and stays 0."""
    dn = np.asarray(dn, float)
    return np.where(dn == 0, 0.0, (dn + offset) / quantification)


def components(mask: np.ndarray, corners: bool = False) -> np.ndarray:
    """Labels 1, 2, ... of connected pixels by first pixel in raster order, 0 outside; ``corners``: diagonals connect.

    Runs of a row are joined with the runs of the row above that they touch, by union-find over runs.
    """
    mask = np.asarray(mask, bool)
    h, w = mask.shape
    padded = np.zeros((h, w + 2), np.int8)
    padded[:, 1:-1] = mask
    step = np.diff(padded, axis=1)
    rows, starts = np.nonzero(step == 1)
    ends = np.nonzero(step == -1)[1]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first = np.searchsorted(rows, np.arange(h + 1))
    reach = 1 if corners else 0
    for r in range(1, h):
        i, j = int(first[r - 1]), int(first[r])
        top, bottom = j, int(first[r + 1])
        while i < top and j < bottom:
            if starts[i] < ends[j] + reach and starts[j] < ends[i] + reach:
                a, b = find(i), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    roots = [find(k) for k in range(len(rows))]
    number = {root: n for n, root in enumerate(sorted(set(roots)), 1)}
    out = np.zeros((h, w), np.int32)
    for r, s, e, root in zip(rows.tolist(), starts.tolist(), ends.tolist(), roots):
        out[r, s:e] = number[root]
    return out


def screen(scl: np.ndarray, t: Thresholds) -> tuple[bool, bool]:
    """Whether a block is too cloudy to look at, and whether it counts as cloud-free; an empty one is neither cloudy."""
    if scl.size == 0:
        return False, True
    share = np.isin(scl, CLOUD_CLASSES).mean()
    return (True, False) if share > t.max_cloud_local else (False, bool(share <= t.cloud_free_thresh))


def hot_core(b12: np.ndarray, inside: np.ndarray, peak: tuple[int, int], threshold: float) -> np.ndarray:
    """Pixels of the component connected to the peak over pixels above ``threshold``; the peak always belongs."""
    warm = inside & (b12 > threshold)
    warm[peak] = True
    labels = components(warm)
    return labels == labels[peak]


def hot_mask(b12: np.ndarray, b11: np.ndarray, b8a: np.ndarray | None, t: Thresholds) -> tuple[np.ndarray | None, float]:
    """Pixels that pass the spectral rule, and the background; None with fewer than ten background pixels.

    The background is the upper median of pixels under the B12 floor, no data among them.
    """
    low = np.sort(b12[b12 < t.b12_min])
    if len(low) < 10:
        return None, 0.0
    background = float(low[len(low) // 2])
    hot = (b12 > t.b12_min) & (b11 > t.b11_min) & (b12 > max(background, t.background_floor) * t.contrast_ratio)
    if b8a is None:
        return hot & (b11 > t.saturation), background
    total = b11 + b8a
    index = np.divide(b11 - b8a, total, out=np.zeros_like(total), where=total > 0.01)
    return hot & ((index > 0) | (b11 > t.saturation) | (b12 > t.saturation)), background


def detect(b12: np.ndarray, b11: np.ndarray, b8a: np.ndarray | None, scl: np.ndarray | None, t: Thresholds = Thresholds()) -> tuple[list[dict], bool]:
    """Hot spots of one block of reflectances, in raster order of their first pixel, and whether the block is cloud-free."""
    if b12.size == 0:
        return [], False
    clear = True
    if scl is not None:
        skip, clear = screen(scl, t)
        if skip:
            return [], False
    mask, background = hot_mask(b12, b11, b8a, t)
    if mask is None or not mask.any():
        return [], clear
    labels, out = components(mask), []
    flat, order = labels.ravel(), np.argsort(labels.ravel(), kind="stable")
    edges = np.searchsorted(flat[order], np.arange(1, flat.max() + 2))
    values = b12.ravel()
    for k, (a, b) in enumerate(zip(edges, edges[1:]), 1):
        at = order[a:b]  # ascending: the first of equal peaks is the one of the lowest place
        n, peak_at = len(at), int(at[values[at].argmax()])
        peak, mean = float(values[peak_at]), float(values[at].sum() / n)
        flat_spot = n > 1 and peak < t.peakedness_min * mean and mean < t.saturation
        if n > t.max_pixels or peak < t.peak_b12_min or (n > t.large_pixels and peak < t.large_b12_min) or flat_spot or (n == 1 and peak < t.single_pixel_min):
            continue
        place = divmod(peak_at, b12.shape[1])
        core = hot_core(b12, labels == k, place, max(peak * t.warm_fraction, t.hot_floor))
        pixels = int(core.sum())
        if pixels > t.warm_max_pixels:
            continue
        peak_b11 = float(b11[place])
        out.append({
            "row": place[0], "col": place[1], "max_b12": peak, "avg_b12": mean, "max_b11": peak_b11, "b12_b11_ratio": peak / peak_b11 if peak_b11 > 1e-6 else float("inf"),
            "peakedness": peak / mean, "pixels": pixels, "radiance": float(np.maximum(b12[core] - background, 0).sum()), "saturated": int(peak >= t.saturation),
        })
    return out, clear


def align(fixed: np.ndarray, moving: np.ndarray, channels: tuple[int, int, int], most: int = 5) -> tuple[np.ndarray, tuple[float, float]]:
    """``moving`` (channels x rows x columns) shifted onto ``fixed``, and the shift (x, y).

    The shift is the one of best correlation among whole shifts of up to ``most`` pixels over the middle 80 per cent
    of the channels' mean, refined by a parabola on each axis; longer ones count as none.  Borders repeat.
    """
    a, b = (np.asarray(x, np.float32)[list(channels)].mean(axis=0, dtype=np.float32).astype(float) for x in (fixed, moving))
    h, w = a.shape
    keep = round(min(h, w) * 0.8 + 1e-9)
    my, mx = (h - min(keep, h)) // 2, (w - min(keep, w)) // 2
    scores = np.full((2 * most + 1, 2 * most + 1), -np.inf)
    for dy in range(-most, most + 1):
        for dx in range(-most, most + 1):
            y0, y1, x0, x1 = max(my, dy), min(h - my, h + dy), max(mx, dx), min(w - mx, w + dx)
            if y1 <= y0 or x1 <= x0:
                continue
            p, q = a[y0:y1, x0:x1], b[y0 - dy : y1 - dy, x0 - dx : x1 - dx]
            n = p.size
            va, vb = max((p * p).sum() - p.sum() ** 2 / n, 0.0), max((q * q).sum() - q.sum() ** 2 / n, 0.0)
            if va > 0 and vb > 0:
                scores[dy + most, dx + most] = ((p * q).sum() - p.sum() * q.sum() / n) / np.sqrt(va * vb)
    iy, ix = np.unravel_index(int(scores.argmax()), scores.shape)
    shift = [float(ix - most), float(iy - most)] if np.isfinite(scores.max()) else [0.0, 0.0]

    def refine(before: float, here: float, after: float) -> float:
        bend = before - 2 * here + after
        return 0.0 if not np.isfinite(bend) or abs(bend) < 1e-12 else float(np.clip(0.5 * (before - after) / bend, -0.5, 0.5))

    if 0 < ix < 2 * most:
        shift[0] += refine(*scores[iy, ix - 1 : ix + 2])
    if 0 < iy < 2 * most:
        shift[1] += refine(*scores[iy - 1 : iy + 2, ix])
    if np.hypot(*shift) > most:
        shift = [0.0, 0.0]
    return warp(moving, *shift), (shift[0], shift[1])


def warp(image: np.ndarray, tx: float, ty: float) -> np.ndarray:
    """Each channel moved by (tx, ty), bilinear, borders repeated."""
    image = np.asarray(image, np.float32)
    h, w = image.shape[1:]
    x, y = np.arange(w) - tx, np.arange(h) - ty
    ax, ay = np.floor(x).astype(int), np.floor(y).astype(int)
    wx, wy = (x - ax).astype(np.float32), (y - ay).astype(np.float32)[:, None]
    rows = lambda k: np.clip(ay + k, 0, h - 1)
    cols = lambda k: np.clip(ax + k, 0, w - 1)
    line = lambda k: image[:, rows(k)][:, :, cols(0)] * (1 - wx) + image[:, rows(k)][:, :, cols(1)] * wx
    return line(0) * (1 - wy) + line(1) * wy


def _ratio(b11: np.ndarray, b12: np.ndarray) -> np.ndarray:
    """B12 / B11 over its lower median, within 0 and 10; 1 over the median where there is no B11."""
    there = b11 != 0
    out = np.ones_like(b11)
    np.divide(b12, b11, out=out, where=there)
    values = np.sort(out[there])
    return np.clip(out / (values[(len(values) - 1) // 2] if len(values) else 1.0), 0, 10)


def network_input(target: np.ndarray, background: np.ndarray, valid: np.ndarray, wind: tuple[float, float]) -> np.ndarray:
    """16 channels: ratio of ratios, six target and six background bands / 5000, wind / 8, cloud."""
    t, b = np.asarray(target, np.float32) / np.float32(5000), np.asarray(background, np.float32) / np.float32(5000)
    top, low = _ratio(t[4], t[5]), _ratio(b[4], b[5])
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = top / low
    ratio = np.where(np.isfinite(ratio), np.minimum(ratio, 10), 1).astype(np.float32)
    plane = lambda v: np.full(valid.shape, v, np.float32)
    return np.stack([ratio, *t, *b, plane(wind[0] / 8), plane(wind[1] / 8), (~valid).astype(np.float32)])


def retrieval_ratio(target: np.ndarray, background: np.ndarray, valid: np.ndarray, plume: np.ndarray, b11: int, b12: int) -> np.ndarray:
    """Ratio of mean-normalised B12 / B11, the target's mean over valid pixels outside the plume; 1 where either is unknown."""

    def normal(image: np.ndarray, keep: np.ndarray) -> np.ndarray:
        den, num = image[b11].astype(float), image[b12].astype(float)
        out = np.divide(num, den, out=np.zeros_like(den), where=den != 0)
        known = (den != 0) & np.isfinite(out)
        out = np.where(known, np.clip(out, 0, 10), 0)
        picked = out[known & keep]
        return out / (picked.mean() if len(picked) else 1.0)

    a, b = normal(target, valid & ~plume), normal(background, np.ones_like(valid))
    out = np.divide(a, b, out=np.ones_like(a), where=(a != 0) & (b != 0))
    return np.where((a != 0) & (b != 0), np.clip(out, 0, 10), 1.0)


class Cubic:
    """Not-a-knot cubic through four points or more, also beyond its ends; the axis may descend."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        x, y = np.asarray(x, float), np.asarray(y, float)
        if len(x) < 4 or len(x) != len(y):
            raise ValueError("cubic interpolation needs four points")
        if x[0] > x[-1]:
            x, y = x[::-1], y[::-1]
        h = np.diff(x)
        if (h <= 0).any():
            raise ValueError("the axis of an interpolation must ascend or descend")
        n = len(x)
        m, rhs = np.zeros((n, n)), np.zeros(n)
        m[0, :3] = -h[1], h[0] + h[1], -h[0]
        m[-1, -3:] = -h[-1], h[-2] + h[-1], -h[-2]
        inner = np.arange(1, n - 1)
        m[inner, inner - 1], m[inner, inner], m[inner, inner + 1] = h[:-1], 2 * (h[:-1] + h[1:]), h[1:]
        rhs[1:-1] = 6 * np.diff(np.diff(y) / h)
        self.x, self.y, self.h, self.bend = x, y, h, np.linalg.solve(m, rhs)

    def __call__(self, at: np.ndarray | float) -> np.ndarray:
        at = np.asarray(at, float)
        k = np.clip(np.searchsorted(self.x, at, "right") - 1, 0, len(self.h) - 1)
        span, left, right = self.h[k], self.x[k + 1] - at, at - self.x[k]
        curve = (self.bend[k] * left**3 + self.bend[k + 1] * right**3) / (6 * span)
        return curve + (self.y[k] - self.bend[k] * span**2 / 6) * left / span + (self.y[k + 1] - self.bend[k + 1] * span**2 / 6) * right / span


@dataclass(frozen=True)
class Transmittance:
    """Lookup table of one satellite: rows by air mass, columns by concentration."""

    amf: np.ndarray
    methane: np.ndarray
    b12: np.ndarray
    b11: np.ndarray
    b12_background: np.ndarray
    b11_background: np.ndarray
    concentration: float = 1800.0

    @classmethod
    def read(cls, data: dict, satellite: str) -> Transmittance:
        """From the parsed JSON of a table; satellites S2A, S2B and S2C are known."""
        if satellite not in ("S2A", "S2B", "S2C"):
            raise ValueError(f"no transmittance table for {satellite}")
        own = data[satellite]
        one = lambda name: np.array(own[name], float).reshape(len(data["amf_arr"]), -1)
        return cls(np.array(data["amf_arr"], float), np.array(data["mr_ch4_arr"], float), one("transmittance_b12"), one("transmittance_b11"), one("transmittance_b12_bg")[:, 0], one("transmittance_b11_bg")[:, 0], float(data["background_concentration"]))


def enhancement(ratio: np.ndarray, sun_zenith: float, view_zenith: float, table: Transmittance) -> np.ndarray:
    """Methane above background in ppb for ratios of ratios; exactly 1 and unknown ones give 0."""
    amf = min(1 / np.cos(np.radians(view_zenith)) + 1 / np.cos(np.radians(sun_zenith)), table.amf[-1])
    row = lambda t: np.array([Cubic(table.amf, t[:, k])(amf) for k in range(t.shape[1])])
    methane, b12, b11 = row(table.methane), row(table.b12), row(table.b11)
    shift = float(Cubic(table.amf, table.b12_background)(amf) / Cubic(table.amf, table.b11_background)(amf))
    ratio = np.asarray(ratio, float)
    known = np.isfinite(ratio) & (ratio != 1.0)
    out = Cubic(b12 / b11, methane)(np.clip(np.where(known, ratio, 1.0), 0.3, 1.08) * shift) - table.concentration
    return np.where(known, out, 0.0)


def plumes(probability: np.ndarray, threshold: float = 0.5, least: int = 100) -> np.ndarray:
    """Labels of 8-connected pixels above ``threshold`` in components of ``least`` pixels or more."""
    labels = components(probability > threshold, corners=True)
    sizes = np.bincount(labels.ravel())
    sizes[0] = 0
    keep = np.flatnonzero(sizes >= least)
    number = np.zeros(len(sizes), np.int32)
    number[keep] = np.arange(1, len(keep) + 1)
    return number[labels]


def scene_score(probability: np.ndarray, least: int = 100) -> float:
    """Highest cut that leaves a component of ``least`` pixels: middle of a bracket halved down to a thousandth, in single precision."""
    if probability.size == 0:
        return 0.0
    half, low, high = np.float32(0.5), np.float32(probability.min()), np.float32(probability.max())
    while high - low > np.float32(1e-3):
        middle = (low + high) * half
        if (plumes(probability, middle, least) > 0).sum() >= least:
            low = middle
        else:
            high = middle
    return float((low + high) * half)


def dissimilarity(target: np.ndarray, background: np.ndarray, valid_t: np.ndarray, valid_b: np.ndarray) -> float:
    """Mean absolute difference of brightness-normalised bands over pixels valid in both; infinite without any."""
    both = valid_t & valid_b
    if target.shape != background.shape or not both.any():
        return float("inf")
    moved, _ = align(target, background, (2, 1, 0))
    t, b = np.asarray(target, float) / 10000, moved.astype(float) / 10000
    mean_t, mean_b = t[:, valid_t].sum(axis=1) / max(1, valid_t.sum()), b[:, valid_b].sum(axis=1) / max(1, valid_b.sum())
    scale = np.divide(mean_t, mean_b, out=np.ones_like(mean_t), where=mean_b != 0)
    return float(np.float32(np.abs(t - b * scale[:, None, None]).mean(axis=0)[both].mean()))


def decimate(image: np.ndarray, step: int = 2) -> np.ndarray:
    """Every ``step``-th row and column of the last two axes."""
    return image[..., ::step, ::step]


def bilinear_20m(image: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """A 20 m grid on a 10 m grid of ``shape``, pixel centres half a fine pixel off, borders repeated."""
    h, w = image.shape
    y, x = (np.arange(shape[0]) + 0.5) / 2 - 0.5, (np.arange(shape[1]) + 0.5) / 2 - 0.5
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    wy, wx = (y - y0)[:, None], x - x0
    at = lambda a, b: image[np.clip(y0 + a, 0, h - 1)][:, np.clip(x0 + b, 0, w - 1)]
    return (at(0, 0) * (1 - wx) + at(0, 1) * wx) * (1 - wy) + (at(1, 0) * (1 - wx) + at(1, 1) * wx) * wy


def pad_to(image: np.ndarray, multiple: int = 32) -> np.ndarray:
    """Rows and columns mirrored (edge not repeated) up to a multiple."""
    h, w = image.shape[-2:]
    grow = [(0, 0)] * (image.ndim - 2) + [(0, -h % multiple), (0, -w % multiple)]
    return np.pad(image, grow, mode="reflect")
