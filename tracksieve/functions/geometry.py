"""Boxes: sizes, clamps, overlaps, filters by size."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def width(x1="x1", x2="x2") -> Column:
    return F.col(x2) - F.col(x1)


def height(y1="y1", y2="y2") -> Column:
    return F.col(y2) - F.col(y1)


def area() -> Column:
    return width() * height()


def corners(cx: Column, cy: Column, bw: Column, bh: Column, w: Column, h: Column) -> list[Column]:
    """Pixel corners of a normalised centre box, clamped to the frame."""
    zero = F.lit(0.0)
    return [
        F.greatest(zero, (cx - bw / 2) * w).alias("x1"), F.greatest(zero, (cy - bh / 2) * h).alias("y1"),
        F.least(w, (cx + bw / 2) * w).alias("x2"), F.least(h, (cy + bh / 2) * h).alias("y2"),
    ]


def crop_window(w: Column, h: Column) -> list[Column]:
    """Integer window within the frame and whether it is empty."""
    x1, y1 = (F.greatest(F.lit(0), F.floor(c)).cast("int") for c in ("x1", "y1"))
    x2, y2 = F.least(w, F.floor("x2")).cast("int"), F.least(h, F.floor("y2")).cast("int")
    return [x1.alias("wx1"), y1.alias("wy1"), x2.alias("wx2"), y2.alias("wy2"), ((x2 <= x1) | (y2 <= y1)).alias("is_empty")]


def face_quality() -> Column:
    return F.least(F.greatest(width() * height() / 40000.0, F.lit(0.1)), F.lit(1.0))


def iou(a: str = "a_", b: str = "b_") -> Column:
    """Intersection over union with the guard 1e-9; a and b prefix x1, y1, x2, y2."""
    c = lambda p, n: F.col(f"{p}{n}")
    zero = F.lit(0.0)
    inter = F.greatest(zero, F.least(c(a, "x2"), c(b, "x2")) - F.greatest(c(a, "x1"), c(b, "x1"))) * F.greatest(
        zero, F.least(c(a, "y2"), c(b, "y2")) - F.greatest(c(a, "y1"), c(b, "y1"))
    )
    own = lambda p: (c(p, "x2") - c(p, "x1")) * (c(p, "y2") - c(p, "y1"))
    return inter / (own(a) + own(b) - inter + 1e-9)


def keep_detection(min_logo_px: int = 32, min_face_px: int = 80, score: float = 0.5) -> Column:
    """Logos by width; faces by both sides and score."""
    face = (width() >= min_face_px) & (height() >= min_face_px) & (F.col("det_score") >= score)
    return F.when(F.col("entity_type") == "logo", width() >= min_logo_px).otherwise(face)
