"""Pixels: contrast, denoising, binarisation, skew, ink, thumbnails and registration, over columns of gray bytes with their width and height.
Images never leave their batch. Everything is numpy; borders and kernels are those that the rules name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _gray(content: bytes, width: int, height: int):
    import numpy as np

    return np.frombuffer(content, np.uint8).reshape(height, width)


def stretched(gray):
    """Values between the 1st and 99th percentile spread over 0 to 255; a flat image stays."""
    import numpy as np

    lo, hi = np.percentile(gray, (1, 99))
    return gray if hi <= lo else np.clip((gray - lo) * (255.0 / (hi - lo)), 0, 255).astype(np.uint8)


def _smoothed(gray, kernel, mode: str):
    """A separable kernel over an image whose border is mirrored (reflect) or repeated (edge)."""
    import numpy as np

    half = len(kernel) // 2
    padded = np.pad(gray.astype(np.float64), half, mode=mode)
    rows = sum(k * padded[i : i + gray.shape[0], :] for i, k in enumerate(kernel))
    return sum(k * rows[:, i : i + gray.shape[1]] for i, k in enumerate(kernel))


def blurred(gray):
    """Smoothed over three by three pixels."""
    import numpy as np

    return np.rint(_smoothed(gray, (0.25, 0.5, 0.25), "reflect")).astype(np.uint8) if min(gray.shape) > 1 else gray


def denoised(gray, radius: int = 2, color: float = 30.0, space: float = 5.0):
    """Bilateral smoothing: neighbours within the radius weigh by distance and by difference of value."""
    import numpy as np

    if min(gray.shape) <= radius:
        return gray
    own, padded = gray.astype(np.float64), np.pad(gray.astype(np.float64), radius, mode="reflect")
    total, weights = np.zeros(gray.shape), np.zeros(gray.shape)
    for dy in range(-radius, radius + 1):
        for dx in range(-radius, radius + 1):
            if dy * dy + dx * dx <= radius * radius:
                other = padded[radius + dy : radius + dy + gray.shape[0], radius + dx : radius + dx + gray.shape[1]]
                w = np.exp(-(dy * dy + dx * dx) / (2 * space**2) - (other - own) ** 2 / (2 * color**2))
                total, weights = total + w * other, weights + w
    return np.rint(total / weights).astype(np.uint8)


def ink(gray, window: int = 21, offset: int = 10, gaussian: bool = False):
    """Where a pixel is not above the mean around it less the offset; edges are repeated. gaussian: a mean that weighs near pixels more."""
    import numpy as np

    half = window // 2
    if gaussian:
        sigma = 0.3 * ((window - 1) * 0.5 - 1) + 0.8
        kernel = np.exp(-((np.arange(window) - half) ** 2) / (2 * sigma**2))
        mean = _smoothed(gray, kernel / kernel.sum(), "edge")
    else:
        sums = np.pad(np.pad(gray.astype(np.int64), half, mode="edge").cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        mean = (sums[window:, window:] - sums[:-window, window:] - sums[window:, :-window] + sums[:-window, :-window]) / window**2
    return gray <= np.rint(mean) - offset


def labelled(mask):
    """(labels, n): connected areas (eight neighbours) numbered from 1, by joining the runs of neighbouring rows."""
    import numpy as np

    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    stop = np.nonzero(edge == -1)[1]
    top = np.arange(len(row))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    first = np.searchsorted(row, np.arange(mask.shape[0] + 1))
    for y in range(1, mask.shape[0]):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if start[i] <= stop[j] and start[j] <= stop[i]:
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
            if stop[i] < stop[j]:
                i += 1
            else:
                j += 1
    roots = np.array([root(i) for i in range(len(row))], np.int64)
    _, number = np.unique(roots, return_inverse=True)
    out = np.zeros(mask.shape, np.int32)
    out[mask] = np.repeat(number + 1, stop - start)
    return out, int(number.max(initial=-1)) + 1


def components(mask, least: int) -> int:
    """Connected areas of at least so many pixels."""
    import numpy as np

    return int((np.bincount(labelled(mask)[0].ravel())[1:] >= least).sum())


def grown(mask, height: int, width: int, back: bool = False):
    """Where any pixel of the rectangle around a pixel is set; of even sizes, the one that ends there, or with back the one that begins there."""
    import numpy as np

    up, left = (height - 1) // 2 if back else height // 2, (width - 1) // 2 if back else width // 2
    padded = np.pad(mask, ((up, height - 1 - up), (left, width - 1 - left)))
    return np.lib.stride_tricks.sliding_window_view(padded, (height, width)).any((2, 3))


def shrunk(mask, height: int, width: int, back: bool = False):
    """Where all pixels of that rectangle are set; outside counts as set."""
    return ~grown(~mask, height, width, back)


def skew(mask) -> float:
    """Degrees by which text lines lean: the median direction of connected areas' longer axes; 0 below half a degree, 5 at most."""
    import numpy as np

    areas, n = labelled(grown(mask, 1, 3))
    angles = []
    for i in range(1, n + 1):
        y, x = np.nonzero(areas == i)
        if len(x) >= 30 and np.ptp(x) * np.ptp(y) >= 50:
            (a, b), (_, d) = np.cov(np.stack([x, y]))
            angles.append(np.degrees(0.5 * np.arctan2(2 * b, a - d)))
    angle = float(np.median(angles)) if angles else 0.0
    return 0.0 if abs(angle) < 0.5 else max(-5.0, min(5.0, angle))


def rotated(gray, degrees: float):
    """Turned about the middle, edges repeated, values between pixels by distance; less than half a degree is left."""
    import numpy as np

    if abs(degrees) < 0.5:
        return gray
    h, w = gray.shape
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    y, x = np.mgrid[:h, :w]
    return _sampled(gray, c * (x - w / 2) - s * (y - h / 2) + w / 2, s * (x - w / 2) + c * (y - h / 2) + h / 2)


def _sampled(gray, x, y):
    """Values at places between pixels; outside, those of the edge."""
    import numpy as np

    h, w = gray.shape
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    x0, y0 = np.minimum(x.astype(int), max(w - 2, 0)), np.minimum(y.astype(int), max(h - 2, 0))
    x1, y1 = np.minimum(x0 + 1, w - 1), np.minimum(y0 + 1, h - 1)
    fx, fy, g = x - x0, y - y0, gray.astype(np.float64)
    top, low = g[y0, x0] * (1 - fx) + g[y0, x1] * fx, g[y1, x0] * (1 - fx) + g[y1, x1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def prepared(gray):
    """For recognition: contrast, denoising, binarisation, straightening, binarisation anew, strokes joined; dark ink on white."""
    import numpy as np

    gray = denoised(stretched(gray))
    mask = ink(rotated(gray, skew(ink(gray, gaussian=True))), gaussian=True)
    return np.where(shrunk(grown(mask, 2, 2), 2, 2, back=True), 0, 255).astype(np.uint8)


def signed(gray, share: float = 0.003, areas: int = 10, least: int = 6) -> bool:
    """Whether there is enough ink, in enough areas. Areas are counted in pixels."""
    mask = ink(blurred(gray))
    return bool(mask.mean() >= share and components(grown(shrunk(mask, 2, 2), 2, 2, back=True), least) >= areas)


def png(gray) -> bytes:
    """An 8-bit gray PNG file."""
    import struct
    import zlib

    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", gray.shape[1], gray.shape[0], 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + r.tobytes() for r in gray))) + chunk(b"IEND", b"")


def thumbnail(gray, width: int = 380, height: int = 120) -> str:
    """A data URI of the image as large as fits, with a thin border."""
    import base64

    import numpy as np

    scale = min(width / gray.shape[1], height / gray.shape[0])
    w, h = max(1, round(gray.shape[1] * scale)), max(1, round(gray.shape[0] * scale))
    y, x = np.mgrid[:h, :w]
    out = _sampled(gray, (x + 0.5) / scale - 0.5, (y + 0.5) / scale - 0.5)
    out[[0, -1], :] = 200
    out[:, [0, -1]] = 200
    return "data:image/png;base64," + base64.b64encode(png(out)).decode()


def outlined(gray, boxes, value: int = 0):
    """The image with boxes (x, y, w, h) drawn one pixel wide, for looking at detections and grids."""
    out, (height, width) = gray.copy(), gray.shape
    for x, y, w, h in boxes:
        x1, y1 = int(max(0, x)), int(max(0, y))
        x2, y2 = int(min(width - 1, x + w)), int(min(height - 1, y + h))
        if x1 <= x2 and y1 <= y2:
            out[[y1, y2], x1 : x2 + 1] = value
            out[y1 : y2 + 1, [x1, x2]] = value
    return out


def homography(source, target, reach: float = 5.0, tries: int = 500, least: int = 8):
    """The 3 by 3 map of matched points (n, 2) that most of them agree on within `reach` pixels, fitted to those; None for fewer matches than
    `least`. Which points are tried does not depend on chance."""
    import numpy as np

    source, target = np.asarray(source, float), np.asarray(target, float)
    if len(source) < least:
        return None

    def fitted(a, b):
        x, y, u, v = a[:, 0], a[:, 1], b[:, 0], b[:, 1]
        one, none = np.ones_like(x), np.zeros_like(x)
        rows = np.concatenate([np.stack([x, y, one, none, none, none, -u * x, -u * y, -u], 1), np.stack([none, none, none, x, y, one, -v * x, -v * y, -v], 1)])
        return np.linalg.svd(rows)[2][-1].reshape(3, 3)

    def near(m):
        p = np.c_[source, np.ones(len(source))] @ m.T
        with np.errstate(all="ignore"):
            return np.hypot(*(p[:, :2] / p[:, 2:] - target).T) <= reach

    rng, best = np.random.RandomState(7), np.zeros(len(source), bool)
    for _ in range(tries):
        own = rng.choice(len(source), 4, replace=False)
        found = near(fitted(source[own], target[own]))
        best = found if found.sum() > best.sum() else best
    m = fitted(source[best], target[best]) if best.sum() >= 4 else None
    return m / m[2, 2] if m is not None and m[2, 2] else None


def registered(gray, to_template, width: int, height: int):
    """The image in the template's frame; without a map it is only resized."""
    import numpy as np

    y, x = np.mgrid[:height, :width]
    if to_template is None:
        return _sampled(gray, (x + 0.5) * gray.shape[1] / width - 0.5, (y + 0.5) * gray.shape[0] / height - 0.5)
    p = np.linalg.inv(to_template) @ np.stack([x.ravel(), y.ravel(), np.ones(x.size)])
    return _sampled(gray, (p[0] / p[2]).reshape(x.shape), (p[1] / p[2]).reshape(x.shape))


def _mapped(df: DataFrame, out: str, kind, make) -> DataFrame:
    """Adds or replaces a column made of each row's image."""

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: [make(_gray(c, w, h)) for c, w, h in zip(pdf["content"], pdf["width"], pdf["height"])]})

    return df.mapInPandas(run, df.withColumn(out, kind).schema)


def with_signature(df: DataFrame, share: float = 0.003, areas: int = 10, least: int = 6) -> DataFrame:
    """Adds signature_present to (content, width, height)."""
    return _mapped(df, "signature_present", F.lit(True), lambda g: signed(g, share, areas, least))


def contrasted(df: DataFrame) -> DataFrame:
    """Replaces content by its stretched values."""
    return _mapped(df, "content", F.col("content"), lambda g: stretched(g).tobytes())


def cleaned(df: DataFrame) -> DataFrame:
    """Replaces content by what `prepared` makes of it."""
    return _mapped(df, "content", F.col("content"), lambda g: prepared(g).tobytes())


def with_thumbnail(df: DataFrame) -> DataFrame:
    """Adds image, a data URI."""
    return _mapped(df, "image", F.lit(""), thumbnail)
