"""Raster kernels on numpy arrays of 8-bit pixels: (h, w) or (h, w, 3)."""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

#: Weights of red, green and blue in grey.
GREY = np.array([0.299, 0.587, 0.114])


def to_grey(rgb: np.ndarray) -> np.ndarray:
    return rgb if rgb.ndim == 2 else np.floor(rgb[..., :3].astype(float) @ GREY + 0.5).astype(np.uint8)


def to_binary(img: np.ndarray, threshold: int, inverted: bool = False) -> np.ndarray:
    over = to_grey(img) > threshold
    return np.where(over != inverted, 255, 0).astype(np.uint8)


def _hue(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue in degrees, the largest and the smallest channel, 0 to 1."""
    r, g, b = np.moveaxis(rgb[..., :3].astype(float) / 255, -1, 0)
    v, m = np.maximum(np.maximum(r, g), b), np.minimum(np.minimum(r, g), b)
    d = np.where(v == m, 1, v - m)
    h = np.where(v == r, 60 * (g - b) / d, np.where(v == g, 120 + 60 * (b - r) / d, 240 + 60 * (r - g) / d))
    return np.where(v == m, 0, np.where(h < 0, h + 360, h)), v, m


def _bytes(*channels: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(np.stack(channels, -1)), 0, 255).astype(np.uint8)


def rgb_to_hsv(rgb: np.ndarray) -> np.ndarray:
    h, v, m = _hue(rgb)
    return _bytes(h / 2 % 180, np.where(v == 0, 0, (v - m) / np.where(v == 0, 1, v)) * 255, v * 255)


def rgb_to_hls(rgb: np.ndarray) -> np.ndarray:
    h, v, m = _hue(rgb)
    light = (v + m) / 2
    den = np.where(light < 0.5, v + m, 2 - v - m)
    return _bytes(h / 2 % 180, light * 255, np.where(v == m, 0, (v - m) / np.where(den == 0, 1, den)) * 255)


def _from_hue(h: np.ndarray, chroma: np.ndarray, m: np.ndarray) -> np.ndarray:
    k = h / 60 % 6
    x = chroma * (1 - np.abs(k % 2 - 1))
    z = np.zeros_like(x)
    sector = np.floor(k).astype(int) % 6
    table = [(chroma, x, z), (x, chroma, z), (z, chroma, x), (z, x, chroma), (x, z, chroma), (chroma, z, x)]
    return _bytes(*[(np.choose(sector, [t[i] for t in table]) + m) * 255 for i in range(3)])


def hsv_to_rgb(hsv: np.ndarray) -> np.ndarray:
    h, s, v = hsv[..., 0].astype(float) * 2, hsv[..., 1] / 255, hsv[..., 2] / 255
    return _from_hue(h, v * s, v - v * s)


def hls_to_rgb(hls: np.ndarray) -> np.ndarray:
    h, light, s = hls[..., 0].astype(float) * 2, hls[..., 1] / 255, hls[..., 2] / 255
    chroma = (1 - np.abs(2 * light - 1)) * s
    return _from_hue(h, chroma, light - chroma / 2)


def to_rgb(img: np.ndarray, space: str) -> np.ndarray:
    if space in ("GRAYSCALE", "BINARY"):
        return np.repeat(img[..., None], 3, -1)
    return {"HSV": hsv_to_rgb, "HLS": hls_to_rgb, "BGR": lambda i: i[..., ::-1], "RGB": lambda i: i}[space](img)


def _channels(img: np.ndarray, f) -> np.ndarray:
    return f(img) if img.ndim == 2 else np.stack([f(img[..., k]) for k in range(img.shape[-1])], -1)


def scale_levels(img: np.ndarray, alpha: float, beta: float) -> np.ndarray:
    return np.clip(np.rint(img * alpha + beta), 0, 255).astype(np.uint8)


def gamma(img: np.ndarray, value: float) -> np.ndarray:
    return np.rint((np.arange(256) / 255) ** (1 / value) * 255).astype(np.uint8)[img]


def _equalized(counts: np.ndarray) -> np.ndarray:
    total = np.cumsum(counts)
    low, n = total[np.flatnonzero(counts)[0]] if counts.any() else 0, total[-1]
    return np.arange(256).astype(np.uint8) if n == low else np.clip(np.rint((total - low) * 255 / (n - low)), 0, 255).astype(np.uint8)


def equalize(img: np.ndarray) -> np.ndarray:
    return _channels(img, lambda c: _equalized(np.bincount(c.ravel(), minlength=256))[c])


def clahe(img: np.ndarray, limit: float, tiles: int) -> np.ndarray:
    """Equalization by tiles, with clipped histograms and bilinear blending."""

    def one(c: np.ndarray) -> np.ndarray:
        h, w = c.shape
        ys, xs = np.linspace(0, h, tiles + 1).astype(int), np.linspace(0, w, tiles + 1).astype(int)
        luts = np.zeros((tiles, tiles, 256))
        for i in range(tiles):
            for j in range(tiles):
                part = c[ys[i] : ys[i + 1], xs[j] : xs[j + 1]]
                counts = np.bincount(part.ravel(), minlength=256).astype(float)
                top = max(limit * part.size / 256, 1)
                counts = np.minimum(counts, top) + np.maximum(counts - top, 0).sum() / 256
                luts[i, j] = np.cumsum(counts) * 255 / max(part.size, 1)
        fy = np.clip((np.arange(h) + 0.5) * tiles / h - 0.5, 0, tiles - 1)
        fx = np.clip((np.arange(w) + 0.5) * tiles / w - 0.5, 0, tiles - 1)
        i, j = np.minimum(fy.astype(int), max(tiles - 2, 0)), np.minimum(fx.astype(int), max(tiles - 2, 0))
        a, b = (fy - i)[:, None], (fx - j)[None]
        i, j = i[:, None], j[None]
        i1, j1 = np.minimum(i + 1, tiles - 1), np.minimum(j + 1, tiles - 1)
        out = (luts[i, j, c] * (1 - b) + luts[i, j1, c] * b) * (1 - a) + (luts[i1, j, c] * (1 - b) + luts[i1, j1, c] * b) * a
        return np.clip(np.rint(out), 0, 255).astype(np.uint8)

    return _channels(img, one)


def convolve(img: np.ndarray, kernel: np.ndarray, mode: str = "reflect") -> np.ndarray:
    """Correlation with an odd kernel, as floats; borders mirrored without the edge pixel."""
    ky, kx = kernel.shape

    def one(c: np.ndarray) -> np.ndarray:
        p = np.pad(c.astype(float), ((ky // 2,) * 2, (kx // 2,) * 2), mode=mode if min(c.shape) > max(ky, kx) // 2 else "edge")
        return np.einsum("ijkl,kl->ij", np.lib.stride_tricks.sliding_window_view(p, (ky, kx)), kernel)

    return _channels(img, one)


def gaussian_kernel(size: int, sigma: float) -> np.ndarray:
    sigma = sigma if sigma > 0 else 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.arange(size) - size // 2
    k = np.exp(-(x**2) / (2 * sigma**2))
    return np.outer(k, k) / k.sum() ** 2


def smooth(img: np.ndarray, size: int, sigma: float) -> np.ndarray:
    return np.clip(np.rint(convolve(img, gaussian_kernel(size, sigma))), 0, 255).astype(np.uint8)


def sharpen(img: np.ndarray, method: str = "Laplacian", size: int = 3, strength: float = 1.0, sigma: float = 1.0, kernel: np.ndarray | None = None) -> np.ndarray:
    if method == "UnsharpMask":
        out = img + strength * (img.astype(float) - convolve(img, gaussian_kernel(size, sigma)))
    else:
        if kernel is None:
            kernel = -np.ones((size, size))
            kernel[size // 2, size // 2] = size * size
        out = convolve(img, np.asarray(kernel, float))
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def element(shape: str, size: int) -> np.ndarray:
    if shape == "MORPH_CROSS":
        k = np.zeros((size, size), bool)
        k[size // 2] = k[:, size // 2] = True
        return k
    if shape == "MORPH_ELLIPSE":
        r = size // 2
        k = np.zeros((size, size), bool)
        for i in range(size):
            d = round(r * math.sqrt(max(0.0, 1 - ((i - r) / r) ** 2))) if r else 0
            k[i, max(r - d, 0) : r + d + 1] = True
        return k
    return np.ones((size, size), bool)


def morphology(img: np.ndarray, method: str, shape: str = "MORPH_RECT", size: int = 3, iterations: int = 1) -> np.ndarray:
    """Opening or closing; beyond the border nothing counts."""
    k = element(shape, size)

    def rank(c: np.ndarray, largest: bool) -> np.ndarray:
        p = np.pad(c, size // 2, constant_values=0 if largest else 255)
        views = np.lib.stride_tricks.sliding_window_view(p, (size, size))[..., k]
        return views.max(-1) if largest else views.min(-1)

    def one(c: np.ndarray) -> np.ndarray:
        for largest in ((False, True) if method == "MORPH_OPEN" else (True, False)):
            for _ in range(iterations):
                c = rank(c, largest)
        return c

    return _channels(img, one)


def sobel(img: np.ndarray, size: int = 3) -> np.ndarray:
    """Gradient magnitude, scaled so that the greatest is 255."""
    gx, gy = _gradients(to_grey(img), size)
    m = np.hypot(gx, gy)
    return np.rint(m * (255 / m.max())).astype(np.uint8) if m.max() else np.zeros(m.shape, np.uint8)


def _gradients(grey: np.ndarray, size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    s, d = np.array([1.0]), np.array([1.0])
    for _ in range(size - 1):
        s = np.convolve(s, [1, 1])
    for _ in range(size - 3 + 0):
        d = np.convolve(d, [1, 1])
    d = np.convolve(d, [-1, 0, 1])
    return convolve(grey, np.outer(s, d)), convolve(grey, np.outer(d, s))


def canny(img: np.ndarray, low: float, high: float) -> np.ndarray:
    """Edges: gradient maxima across the edge, kept if strong or linked to strong ones."""
    gx, gy = _gradients(to_grey(img))
    m = np.abs(gx) + np.abs(gy)
    p = np.pad(m, 1)
    angle = np.degrees(np.arctan2(gy, gx)) % 180
    sector = ((angle + 22.5) // 45).astype(int) % 4
    step = [(0, 1), (1, 1), (1, 0), (1, -1)]
    h, w = m.shape
    keep = np.zeros(m.shape, bool)
    for k, (dy, dx) in enumerate(step):
        a, b = p[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w], p[1 - dy : 1 - dy + h, 1 - dx : 1 - dx + w]
        keep |= (sector == k) & (m > b) & (m >= a)
    weak = keep & (m > min(low, high))
    labels, n = label(weak, eight=True)
    strong = np.unique(labels[weak & (m > max(low, high))])
    return np.where(np.isin(labels, strong[strong > 0]), 255, 0).astype(np.uint8)


def label(mask: np.ndarray, eight: bool = True) -> tuple[np.ndarray, int]:
    """Connected components, numbered from 1 in scan order, by joining runs of each row."""
    h, w = mask.shape
    out = np.zeros((h, w), int)
    parent = [0]

    def find(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    above: list[tuple[int, int, int]] = []
    reach = 1 if eight else 0
    for y in range(h):
        edges = np.flatnonzero(np.diff(np.r_[0, mask[y].astype(np.int8), 0]))
        row = []
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            own = 0
            for a, b, k in above:
                if a < e + reach and b > s - reach:
                    k = find(k)
                    if own and own != k:
                        own, k = min(own, k), max(own, k)
                        parent[k] = own
                    else:
                        own = k
            if not own:
                parent.append(len(parent))
                own = len(parent) - 1
            out[y, s:e] = own
            row.append((s, e, own))
        above = row
    roots = np.array([find(k) for k in range(len(parent))])
    used = np.unique(roots[1:])
    number = np.zeros(len(parent), int)
    number[used] = np.arange(1, len(used) + 1)
    return number[roots[out]] if len(used) else out, len(used)


def regions(mask: np.ndarray, least: int, most: int | None = None, largest_first: bool = False, limit: int | None = None) -> list[tuple[int, int, int, int, int]]:
    """x, y, w, h, area of components whose area is within bounds."""
    labels, n = label(mask > 0)
    out = []
    for k in range(1, n + 1):
        ys, xs = np.nonzero(labels == k)
        if len(xs) >= least and (most is None or len(xs) <= most):
            out.append((int(xs.min()), int(ys.min()), int(np.ptp(xs)) + 1, int(np.ptp(ys)) + 1, len(xs)))
    out.sort(key=lambda r: -r[4]) if largest_first else None
    return out[:limit]


def contours(mask: np.ndarray, least: float = 0.0, holes: bool = False, corners_only: bool = True) -> list[np.ndarray]:
    """Outer borders of components (and of their holes), traced from neighbour to neighbour, as (n, 2) arrays of x, y."""
    from terravane.functions.geometry import area

    found = []
    layers = [(mask > 0, True)]
    if holes:
        outside, _ = label(np.pad(mask == 0, 1, constant_values=True), eight=False)
        layers.append(((outside != outside[0, 0])[1:-1, 1:-1] & (mask == 0), False))
    around = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]
    for layer, eight in layers:
        labels, n = label(layer, eight)
        p = np.pad(labels, 1)
        for k in range(1, n + 1):
            ys, xs = np.nonzero(p == k)
            start = (int(ys[0]), int(xs[0]))
            path, at, d = [start], start, 7
            first = None
            while True:
                for i in range(8):
                    e = (d + i) % 8
                    q = (at[0] + around[e][0], at[1] + around[e][1])
                    if p[q] == k:
                        break
                else:
                    break
                if (at, e) == first:
                    break
                first = first or (at, e)
                at, d = q, (e + 6) % 8 if e % 2 == 0 else (e + 5) % 8
                path.append(at)
            pts = np.array([(x - 1, y - 1) for y, x in path[:-1] or path], float)
            if corners_only and len(pts) > 2:
                keep = [not np.array_equal(pts[i] - pts[i - 1], pts[(i + 1) % len(pts)] - pts[i]) for i in range(len(pts))]
                pts = pts[keep] if any(keep) else pts
            if (abs(area(pts)) if len(pts) > 2 else 0.0) >= least:
                found.append(pts)
    return found


def rectangles(mask: np.ndarray, least: float, most: float | None = None, largest_first: bool = False, limit: int | None = None, slack: float = 10.0) -> list[np.ndarray]:
    """Contours that simplify to four corners, each within slack degrees of a right angle."""
    from terravane.functions.geometry import area, closed, length, simplify

    out = []
    for c in contours(mask, least):
        q = simplify(closed(c), 0.02 * length(closed(c)))[:-1]
        if len(q) != 4 or most is not None and abs(area(q)) > most:
            continue
        d = np.roll(q, -1, 0) - q
        e = -np.roll(d, 1, 0)
        cos = (d * e).sum(1) / (np.hypot(*d.T) * np.hypot(*e.T))
        if (np.abs(np.degrees(np.arccos(np.clip(cos, -1, 1))) - 90) <= slack).all():
            out.append(q)
    out.sort(key=lambda q: -abs(area(q))) if largest_first else None
    return out[:limit]


def hough_circles(img: np.ndarray, r0: int, r1: int, apart: float, edge: float = 100, votes: float = 0.6) -> list[tuple[int, int, int]]:
    """x, y, r: circles whose border is, by a share of votes, made of edges; stronger ones first."""
    ys, xs = np.nonzero(canny(img, edge / 2, edge))
    h, w = img.shape[:2]
    found = []
    for r in range(max(1, r0), r1 + 1):
        t = np.arange(0, 2 * np.pi, 1 / max(r, 1))
        cy = (ys[:, None] - np.rint(r * np.sin(t)).astype(int)[None]).ravel()
        cx = (xs[:, None] - np.rint(r * np.cos(t)).astype(int)[None]).ravel()
        ok = (cy >= 0) & (cy < h) & (cx >= 0) & (cx < w)
        acc = np.bincount(cy[ok] * w + cx[ok], minlength=h * w) / len(t)
        found += [(float(acc[i]), int(i % w), int(i // w), r) for i in np.flatnonzero(acc >= votes)]
    out: list[tuple[int, int, int]] = []
    for _, x, y, r in sorted(found, reverse=True):
        if all(math.hypot(x - a, y - b) >= apart for a, b, _ in out):
            out.append((x, y, r))
    return out


def hough_lines(mask: np.ndarray, votes: int, least: float, gap: float) -> list[tuple[int, int, int, int]]:
    """x0, y0, x1, y1: segments along the strongest lines, each pixel used once; deterministic, unlike sampling variants."""
    left = mask > 0
    theta = np.arange(180) * math.pi / 180
    c, s = np.cos(theta), np.sin(theta)
    size = int(math.hypot(*mask.shape)) + 1
    out = []
    while True:
        ys, xs = np.nonzero(left)
        if len(xs) < max(votes, 2):
            break
        rho = np.rint(xs[:, None] * c + ys[:, None] * s).astype(int) + size
        acc = np.bincount((rho * 180 + np.arange(180)).ravel(), minlength=(2 * size + 1) * 180)
        best = int(acc.argmax())
        if acc[best] < votes:
            break
        r, k = divmod(best, 180)
        on = np.flatnonzero(np.abs(rho[:, k] - r) <= 1)
        along = -xs[on] * s[k] + ys[on] * c[k]
        order = on[np.argsort(along)]
        a = np.sort(along)
        for part in np.split(order, np.flatnonzero(np.diff(a) > gap) + 1):
            x, y = xs[part], ys[part]
            if math.hypot(x[-1] - x[0], y[-1] - y[0]) >= least:
                out.append((int(x[0]), int(y[0]), int(x[-1]), int(y[-1])))
        left[ys[on], xs[on]] = False
    return out


def thickness(mask: np.ndarray, x0: float, y0: float, x1: float, y1: float, most: int = 50) -> float:
    """Mean width of a line across its direction, in pixels, to 2 digits."""
    n = max(2, int(math.hypot(x1 - x0, y1 - y0)))
    px, py = np.linspace(x0, x1, n), np.linspace(y0, y1, n)
    d = math.hypot(x1 - x0, y1 - y0) or 1.0
    nx, ny = -(y1 - y0) / d, (x1 - x0) / d
    h, w = mask.shape
    total = np.zeros(n)
    for way in (1, -1):
        open_ = np.ones(n, bool)
        for k in range(0 if way == 1 else 1, most):
            x, y = np.rint(px + way * k * nx).astype(int), np.rint(py + way * k * ny).astype(int)
            ok = (x >= 0) & (x < w) & (y >= 0) & (y < h)
            open_ &= ok & (mask[np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)] > 0)
            total += open_
    return round(float(total.mean()), 2)


def warp(img: np.ndarray, matrix: np.ndarray, size: tuple[int, int], nearest: bool = False) -> np.ndarray:
    """An affine change of an image: matrix (2, 3) takes input to output positions; black outside."""
    inv = np.linalg.inv(np.vstack([matrix, [0, 0, 1]]))[:2]
    h, w = size
    y, x = np.mgrid[:h, :w]
    sx, sy = (inv[i, 0] * x + inv[i, 1] * y + inv[i, 2] for i in range(2))

    def one(c: np.ndarray) -> np.ndarray:
        ch, cw = c.shape

        def at(yy: np.ndarray, xx: np.ndarray) -> np.ndarray:
            ok = (yy >= 0) & (yy < ch) & (xx >= 0) & (xx < cw)
            return np.where(ok, c[np.clip(yy, 0, ch - 1), np.clip(xx, 0, cw - 1)], 0).astype(float)

        if nearest:
            return at(np.rint(sy).astype(int), np.rint(sx).astype(int)).astype(np.uint8)
        iy, ix = np.floor(sy + 1e-9).astype(int), np.floor(sx + 1e-9).astype(int)
        fy, fx = sy - iy, sx - ix
        out = (at(iy, ix) * (1 - fx) + at(iy, ix + 1) * fx) * (1 - fy) + (at(iy + 1, ix) * (1 - fx) + at(iy + 1, ix + 1) * fx) * fy
        return np.clip(np.rint(out), 0, 255).astype(np.uint8)

    return _channels(img, one)


def rotation(degrees: float, scale: float, cx: float, cy: float) -> np.ndarray:
    a, b = scale * math.cos(math.radians(degrees)), scale * math.sin(math.radians(degrees))
    return np.array([[a, b, (1 - a) * cx - b * cy], [-b, a, b * cx + (1 - a) * cy]])


def blend(front: np.ndarray, back: np.ndarray, mode: str, alpha: float = 0.5) -> np.ndarray:
    if mode == "maximum":
        return np.maximum(front, back)
    if mode == "minimum":
        return np.minimum(front, back)
    return np.clip(np.rint(front * alpha + back * (1 - alpha)), 0, 255).astype(np.uint8)


def colour_mask(rgb: np.ndarray, colour: tuple[int, int, int], spread: int) -> np.ndarray:
    low, high = np.clip(np.array(colour) - spread, 0, 255), np.clip(np.array(colour) + spread, 0, 255)
    return np.where(((rgb >= low) & (rgb <= high)).all(-1), 255, 0).astype(np.uint8)


def split_tiles(img: np.ndarray, across: int, down: int, overlap: int) -> list[tuple[int, int, np.ndarray]]:
    """x, y and pixels of a grid of tiles, each grown by overlap to the right and below."""
    h, w = img.shape[:2]
    ys, xs = [h * i // down for i in range(down + 1)], [w * i // across for i in range(across + 1)]
    return [(xs[j], ys[i], img[ys[i] : min(h, ys[i + 1] + overlap), xs[j] : min(w, xs[j + 1] + overlap)]) for i in range(down) for j in range(across)]


def merge_tiles(tiles: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Tiles at their offsets; where they overlap the later one counts."""
    h, w = max(y + t.shape[0] for _, y, t in tiles), max(x + t.shape[1] for x, _, t in tiles)
    out = np.zeros((h, w, *tiles[0][2].shape[2:]), np.uint8)
    for x, y, t in tiles:
        out[y : y + t.shape[0], x : x + t.shape[1]] = t
    return out


def fill_regions(img: np.ndarray, boxes: list[tuple[int, int, int, int]], outline: int | None = None, value: int = 255) -> np.ndarray:
    """White rectangles x, y, w, h, or their outlines of a thickness."""
    out = img.copy()
    for x, y, w, h in boxes:
        if outline is None:
            out[y : y + h, x : x + w] = value
        else:
            k = outline
            for part in ((slice(y, y + k), slice(x, x + w)), (slice(y + h - k, y + h), slice(x, x + w)), (slice(y, y + h), slice(x, x + k)), (slice(y, y + h), slice(x + w - k, x + w))):
                out[part] = value
    return out


def clusters(values: np.ndarray, reach: float) -> np.ndarray:
    """Numbers of groups of points that are linked by steps within reach."""
    v = np.asarray(values, float)
    v = v[:, None] if v.ndim == 1 else v
    near = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1)) <= reach
    own = np.arange(len(v))
    while True:
        new = np.where(near, own[None], len(v)).min(1)
        if (new == own).all():
            return np.unique(own, return_inverse=True)[1]
        own = new


def corners(img: np.ndarray, most: int | None, quality: float, apart: float, block: int = 3) -> list[tuple[int, int]]:
    """Strongest corners: the smaller eigenvalue of the gradient's covariance, at least quality of the best; most: None for all."""
    gx, gy = _gradients(to_grey(img))
    k = np.ones((block, block))
    a, b, c = convolve(gx * gx, k), convolve(gx * gy, k), convolve(gy * gy, k)
    e = (a + c) / 2 - np.sqrt(((a - c) / 2) ** 2 + b * b)
    h, w = e.shape
    strong = np.flatnonzero((e.ravel() > 0) & (e.ravel() >= quality * e.max())) if e.size else np.empty(0, np.int64)
    reach = max(0, math.ceil(apart))
    dy, dx = np.mgrid[-reach : reach + 1, -reach : reach + 1]
    near = np.hypot(dx, dy) < apart
    free = np.ones((h + 2 * reach, w + 2 * reach), bool)  # with a margin, so that discs need no clipping
    out: list[tuple[int, int]] = []
    for i in strong[np.argsort(-e.ravel()[strong], kind="stable")]:
        if most is not None and len(out) >= most:
            break
        y, x = divmod(int(i), w)
        if free[y + reach, x + reach]:
            out.append((x, y))
            free[y : y + 2 * reach + 1, x : x + 2 * reach + 1] &= ~near
    return out


def draw_line(img: np.ndarray, x0: int, y0: int, x1: int, y1: int, value=0) -> None:
    n = max(abs(x1 - x0), abs(y1 - y0)) + 1
    x, y = np.rint(np.linspace(x0, x1, n)).astype(int), np.rint(np.linspace(y0, y1, n)).astype(int)
    ok = (x >= 0) & (x < img.shape[1]) & (y >= 0) & (y < img.shape[0])
    img[y[ok], x[ok]] = value


def to_png(img: np.ndarray) -> bytes:
    h, w = img.shape[:2]
    raw = b"".join(b"\0" + row.tobytes() for row in np.ascontiguousarray(img))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if img.ndim == 2 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def from_png(data: bytes) -> np.ndarray:
    """8-bit grey, RGB or RGBA pictures without interlacing."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, parts, head = 8, [], None
    while at < len(data):
        (n,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        if kind == b"IHDR":
            head = struct.unpack_from(">IIBBBBB", data, at + 8)
        elif kind == b"IDAT":
            parts.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    w, h, depth, colour, _, _, interlaced = head
    n = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or n is None or interlaced:
        raise ValueError("only 8-bit pictures without palette or interlacing")
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(h, 1 + w * n)
    out = np.zeros((h, w * n), np.uint8)
    up = np.zeros(w * n, int)
    for y in range(h):
        kind, row = int(raw[y, 0]), raw[y, 1:].astype(int)
        if kind == 2:
            row = (row + up) & 255
        elif kind in (1, 3, 4):
            for i in range(w * n):
                a, b, c = row[i - n] if i >= n else 0, up[i], up[i - n] if i >= n else 0
                if kind == 1:
                    p = a
                elif kind == 3:
                    p = (a + b) // 2
                else:
                    q = a + b - c
                    p = min((abs(q - a), 0, a), (abs(q - b), 1, b), (abs(q - c), 2, c))[2]
                row[i] = (row[i] + p) & 255
        out[y], up = row, row
    img = out.reshape(h, w, n)
    return img[..., 0] if n == 1 else img[..., :3] if n >= 3 else img[..., 0]
