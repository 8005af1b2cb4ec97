"""Image operators: rows layer, findex, color_space, h, w, ch, content (raw pixels), changed in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.functions import pixels as px

COLUMNS = ["layer", "findex", "color_space", "h", "w", "ch", "content"]
SCHEMA = "layer string, findex double, color_space string, h int, w int, ch int, content binary"


def array_of(row) -> np.ndarray:
    a = np.frombuffer(row["content"], np.uint8)
    return a.reshape(row["h"], row["w"]) if row["ch"] == 1 else a.reshape(row["h"], row["w"], row["ch"])


def row_of(layer, findex, space: str, img: np.ndarray, **more) -> dict:
    return {"layer": layer, "findex": findex, "color_space": space, "h": img.shape[0], "w": img.shape[1], "ch": 1 if img.ndim == 2 else img.shape[2], "content": np.ascontiguousarray(img, np.uint8).tobytes(), **more}


def map_images(images: DataFrame, change: Callable[[np.ndarray, str], tuple[np.ndarray, str]]) -> DataFrame:
    """change(pixels, colour space) -> (pixels, colour space), one image at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                img, space = change(array_of(r), r["color_space"])
                out.append(row_of(r["layer"], r["findex"], space, img))
            yield pd.DataFrame(out, columns=COLUMNS)

    return images.select(COLUMNS).mapInPandas(run, SCHEMA)


def detect(images: DataFrame, find: Callable[[np.ndarray], list], schema: str) -> DataFrame:
    """layer, findex, n and the columns of schema: a row for each thing that find reports in an image."""
    names = ["layer", "findex", "n", *[c.split()[0] for c in schema.split(", ")]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(r["layer"], r["findex"], i, *x) for r in f.to_dict("records") for i, x in enumerate(find(array_of(r)))], columns=names)

    return images.select(COLUMNS).mapInPandas(run, f"layer string, findex double, n int, {schema}")


def to_binary(images, threshold: int, inverted: bool = False):
    return map_images(images, lambda a, s: (px.to_binary(a, threshold, inverted), "BINARY"))


def to_grey(images):
    return map_images(images, lambda a, s: (px.to_grey(px.to_rgb(a, s)), "GRAYSCALE"))


def to_hls(images):
    return map_images(images, lambda a, s: (px.rgb_to_hls(px.to_rgb(a, s)), "HLS"))


def to_hsv(images):
    return map_images(images, lambda a, s: (px.rgb_to_hsv(px.to_rgb(a, s)), "HSV"))


def to_rgb(images):
    return map_images(images, lambda a, s: (px.to_rgb(a, s), "RGB"))


def adjust_contrast(images, method: str, alpha: float = 1.0, beta: float = 0.0, gamma: float = 1.0, limit: float = 2.0, tiles: int = 8):
    how = {"AlphaBeta": lambda a: px.scale_levels(a, alpha, beta), "Gamma": lambda a: px.gamma(a, gamma), "HistogramEqualization": px.equalize, "CLAHE": lambda a: px.clahe(a, limit, tiles)}[method]
    return map_images(images, lambda a, s: (how(a), s))


def smooth(images, size: int, sigma: float):
    return map_images(images, lambda a, s: (px.smooth(a, size, sigma), s))


def sharpen(images, method: str = "Laplacian", **options):
    return map_images(images, lambda a, s: (px.sharpen(a, method, **options), s))


def morphology(images, method: str, shape: str = "MORPH_RECT", size: int = 3, iterations: int = 1):
    return map_images(images, lambda a, s: (px.morphology(a, method, shape, size, iterations), s))


def edges(images, method: str = "Canny", low: float = 100, high: float = 200, size: int = 3):
    return map_images(images, lambda a, s: (px.canny(a, low, high) if method == "Canny" else px.sobel(a, size), "GRAYSCALE"))


def reshape(images, method: str, angle: float = 0.0, scale: float = 1.0, centre: tuple | None = None, sx: float = 1.0, sy: float = 1.0, dx: float = 0.0, dy: float = 0.0, nearest: bool = False):
    """Rotation, Scaling, Translation or Shearing."""

    def change(a: np.ndarray, s: str) -> tuple[np.ndarray, str]:
        h, w = a.shape[:2]
        if method == "Rotation":
            return px.warp(a, px.rotation(angle, scale, *(centre or (w / 2, h / 2))), (h, w), nearest), s
        if method == "Scaling":
            return px.warp(a, np.array([[sx, 0, 0], [0, sy, 0]], float), (max(1, round(h * sy)), max(1, round(w * sx))), nearest), s
        m = np.array([[1, 0, dx], [0, 1, dy]], float) if method == "Translation" else np.array([[1, dx, 0], [dy, 1, 0]], float)
        return px.warp(a, m, (h, w), nearest), s

    return map_images(images, change)


def combine(front: DataFrame, back: DataFrame, method: str, mode: str = "weighted_average", alpha: float = 0.5, threshold: int = 127) -> DataFrame:
    """Masking, Transparency or Blending of images of equal layer and findex."""
    both = front.select("layer", "findex", F.struct(*COLUMNS).alias("a")).join(back.select("layer", "findex", F.struct(*COLUMNS).alias("b")), ["layer", "findex"]).select("layer", "findex", "a", "b")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                a, b = array_of(r["a"]), array_of(r["b"])
                if method == "Masking":
                    keep = px.to_grey(b) > threshold
                    img = np.where(keep if a.ndim == 2 else keep[..., None], a, 0)
                elif method == "Transparency":
                    keep = px.to_grey(a) > threshold
                    img = np.where(keep if a.ndim == 2 else keep[..., None], a, b)
                else:
                    img = px.blend(a, b, mode, alpha)
                out.append(row_of(r["layer"], r["findex"], r["a"]["color_space"], img))
            yield pd.DataFrame(out, columns=COLUMNS)

    return both.mapInPandas(run, SCHEMA)


def extract_colours(images: DataFrame, colours: list[tuple[str, tuple[int, int, int]]], spread: int, rest: bool = False) -> DataFrame:
    """A mask a colour, named in `layer`; rest: what no colour covers, too."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                a = array_of(r)
                masks = [(n, px.colour_mask(a, c, spread)) for n, c in colours]
                out += [row_of(f"{r['layer']}_{n}", r["findex"], "BINARY", m) for n, m in masks]
                if rest:
                    out.append(row_of(f"{r['layer']}_other", r["findex"], "BINARY", 255 - np.maximum.reduce([m for _, m in masks])))
            yield pd.DataFrame(out, columns=COLUMNS)

    return images.select(COLUMNS).mapInPandas(run, SCHEMA)


def crop(images: DataFrame, x0: int, y0: int, x1: int, y1: int) -> DataFrame:
    return map_images(images, lambda a, s: (a[y0:y1, x0:x1], s))


def split(images: DataFrame, across: int, down: int, overlap: int) -> DataFrame:
    """Tiles with their offset (dx, dy), numbered in `tile`."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([row_of(r["layer"], r["findex"], r["color_space"], t, tile=i, dx=x, dy=y) for r in f.to_dict("records") for i, (x, y, t) in enumerate(px.split_tiles(array_of(r), across, down, overlap))], columns=[*COLUMNS, "tile", "dx", "dy"])

    return images.select(COLUMNS).mapInPandas(run, SCHEMA + ", tile int, dx int, dy int")


def merge(tiles: DataFrame) -> DataFrame:
    """One image a layer and findex from its tiles."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("tile")
        r = f.iloc[0]
        return pd.DataFrame([row_of(r["layer"], r["findex"], r["color_space"], px.merge_tiles([(x["dx"], x["dy"], array_of(x)) for x in f.to_dict("records")]))], columns=COLUMNS)

    return tiles.groupBy("layer", "findex").applyInPandas(run, SCHEMA)


def merge_circles(found: DataFrame, tiles: DataFrame, reach: float) -> DataFrame:
    """Circles of all tiles in image coordinates, those closer than reach as their mean."""
    placed = found.join(tiles.select("layer", "findex", "tile", "dx", "dy"), ["layer", "findex", "tile"]).select("layer", (F.col("x") + F.col("dx")).cast("double").alias("x"), (F.col("y") + F.col("dy")).cast("double").alias("y"), F.col("r").cast("double").alias("r"))

    def run(f: pd.DataFrame) -> pd.DataFrame:
        return f.assign(c=px.clusters(f[["x", "y"]].to_numpy(), reach)).groupby(["layer", "c"], as_index=False)[["x", "y", "r"]].mean()[["layer", "x", "y", "r"]]

    return placed.groupBy("layer").applyInPandas(run, "layer string, x double, y double, r double")


def merge_lines(found: DataFrame, tiles: DataFrame, reach: float) -> DataFrame:
    """Lines of all tiles in image coordinates, those whose ends agree within reach as their mean."""
    cols = ["x0", "y0", "x1", "y1"]
    placed = found.join(tiles.select("layer", "findex", "tile", "dx", "dy"), ["layer", "findex", "tile"]).select("layer", *[(F.col(c) + F.col(f"d{c[0]}")).cast("double").alias(c) for c in cols])

    def run(f: pd.DataFrame) -> pd.DataFrame:
        return f.assign(c=px.clusters(f[cols].to_numpy(), reach)).groupby(["layer", "c"], as_index=False)[cols].mean()[["layer", *cols]]

    return placed.groupBy("layer").applyInPandas(run, "layer string, x0 double, y0 double, x1 double, y1 double")


def remove_regions(images: DataFrame, boxes: DataFrame, outline: int | None = None) -> DataFrame:
    """Paints boxes (layer, findex, x, y, w, h) white."""
    lists = boxes.groupBy("layer", "findex").agg(F.collect_list(F.struct("x", "y", "w", "h")).alias("boxes"))
    both = images.join(lists, ["layer", "findex"], "left").select(*COLUMNS, "boxes")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([row_of(r["layer"], r["findex"], r["color_space"], px.fill_regions(array_of(r), [(b["x"], b["y"], b["w"], b["h"]) for b in (r["boxes"] if r["boxes"] is not None else [])], outline)) for r in f.to_dict("records")], columns=COLUMNS)

    return both.mapInPandas(run, SCHEMA)


def regions(images, least: int, most: int | None = None, largest_first: bool = False, limit: int | None = None):
    return detect(images, lambda a: px.regions(px.to_grey(a), least, most, largest_first, limit), "x int, y int, w int, h int, area int")


def contours(images, least: float = 0.0, holes: bool = False, corners_only: bool = True):
    return detect(images, lambda a: [([{"x": p[0], "y": p[1]} for p in c],) for c in px.contours(px.to_grey(a), least, holes, corners_only)], "points array<struct<x:double,y:double>>")


def rectangles(images, least: float, most: float | None = None, largest_first: bool = False, limit: int | None = None):
    return detect(images, lambda a: [([{"x": p[0], "y": p[1]} for p in c],) for c in px.rectangles(px.to_grey(a), least, most, largest_first, limit)], "points array<struct<x:double,y:double>>")


def circles(images, r0: int, r1: int, apart: float, edge: float = 100, votes: float = 0.6):
    return detect(images, lambda a: px.hough_circles(a, r0, r1, apart, edge, votes), "x int, y int, r int")


def lines(images, votes: int, least: float, gap: float):
    """x0, y0, x1, y1, length and thickness of straight segments."""
    return detect(images, lambda a: [(*q, float(np.hypot(q[2] - q[0], q[3] - q[1])), px.thickness(px.to_grey(a), *q)) for q in px.hough_lines(px.to_grey(a), votes, least, gap)], "x0 int, y0 int, x1 int, y1 int, length double, thickness double")


def line_approximation(images, most: int = 100, quality: float = 0.05, apart: float = 5.0, size: int = 3):
    """Segments by components: each component of the image, cut at its corners, with a line fitted to what is left."""

    def find(a: np.ndarray) -> list:
        mask = px.to_grey(a) > 0
        cut = mask.copy()
        for x, y in px.corners(a, most, quality, apart):
            cut[max(0, y - size) : y + size + 1, max(0, x - size) : x + size + 1] = False
        labels, n = px.label(cut)
        out = []
        for k in range(1, n + 1):
            ys, xs = np.nonzero(labels == k)
            if len(xs) < 2:
                continue
            c = np.array([xs.mean(), ys.mean()])
            d = np.linalg.svd(np.c_[xs, ys] - c, full_matrices=False)[2][0]
            t = (np.c_[xs, ys] - c) @ d
            p, q = c + t.min() * d, c + t.max() * d
            out.append((float(p[0]), float(p[1]), float(q[0]), float(q[1]), px.thickness(mask.astype(np.uint8), *p, *q)))
        return out

    return detect(images, find, "x0 double, y0 double, x1 double, y1 double, thickness double")


def leader_counts(circles_: DataFrame, lines_: DataFrame, factor: float, reach: float) -> DataFrame:
    """For each leader line (layer, n, x0, y0, x1, y1) the columns and rows of circles around its end: circles within factor radii, turned along the line, clustered across and along."""
    both = lines_.groupBy("layer").agg(F.collect_list(F.struct("n", "x0", "y0", "x1", "y1")).alias("lines")).join(circles_.groupBy("layer").agg(F.collect_list(F.struct("x", "y", "r")).alias("circles")), "layer")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                c = np.array([(q["x"], q["y"], q["r"]) for q in r["circles"]], float)
                for q in r["lines"]:
                    best = (0, 0)
                    for ex, ey, sx, sy in ((q["x1"], q["y1"], q["x0"], q["y0"]), (q["x0"], q["y0"], q["x1"], q["y1"])):
                        near = c[np.hypot(c[:, 0] - ex, c[:, 1] - ey) <= factor * c[:, 2].mean()]
                        if len(near):
                            t = np.arctan2(ey - sy, ex - sx)
                            d = near[:, :2] - [ex, ey]
                            along, across = d @ [np.cos(t), np.sin(t)], d @ [-np.sin(t), np.cos(t)]
                            best = max(best, (px.clusters(across, reach).max() + 1, px.clusters(along, reach).max() + 1))
                    out.append((r["layer"], q["n"], int(best[0]), int(best[1])))
            yield pd.DataFrame(out, columns=["layer", "n", "n_columns", "n_rows"])

    return both.mapInPandas(run, "layer string, n int, n_columns int, n_rows int")


def symbol_angle(contours_: DataFrame) -> DataFrame:
    """Direction of an arrow symbol, in degrees anticlockwise from east: from the middle of a contour's points to the one farthest from it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                p = np.array([(q["x"], -q["y"]) for q in r["points"]], float)
                d = p - p.mean(0)
                tip = d[np.hypot(*d.T).argmax()]
                out.append((r["layer"], r["findex"], r["n"], float(np.degrees(np.arctan2(tip[1], tip[0])))))
            yield pd.DataFrame(out, columns=["layer", "findex", "n", "angle"])

    return contours_.mapInPandas(run, "layer string, findex double, n int, angle double")


def ocr(images: DataFrame, engine: Callable[[np.ndarray], list[tuple[str, int, int, int, int]]]) -> DataFrame:
    """Text boxes by an engine the caller supplies (none comes with this library): engine(pixels) -> (text, x, y, w, h)."""
    return detect(images, engine, "text string, x int, y int, w int, h int")


def decode_png(files: DataFrame, space: str = "RGB") -> DataFrame:
    """Binary files (path, content) as images; the file's name is the layer."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([row_of(p.rsplit("/", 1)[-1], 0.0, space, px.from_png(c)) for p, c in zip(f["path"], f["content"], strict=True)], columns=COLUMNS)

    return files.select("path", "content").mapInPandas(run, SCHEMA)


def key_points(images: DataFrame, most: int | None = None, quality: float = 0.01, apart: float = 3.0) -> DataFrame:
    """Pixel positions px, py of all corners of an image, strongest first, or of the most strongest; pixels_to_points turns them into map positions."""
    return detect(images, lambda a: px.corners(a, most, quality, apart), "px int, py int")
