"""Boxes (l, t, r, b) with the origin at the top left, as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box:
    """The four edges of a box as columns."""

    def __init__(self, l: Column, t: Column, r: Column, b: Column):  # noqa: E741
        self.l, self.t, self.r, self.b = l, t, r, b

    @classmethod
    def of(cls, prefix: str = "", suffix: str = "") -> Box:
        return cls(*(F.col(f"{prefix}{x}{suffix}") for x in "ltrb"))

    @property
    def width(self) -> Column:
        return self.r - self.l

    @property
    def height(self) -> Column:
        return self.b - self.t

    def area(self) -> Column:
        return self.width * self.height

    def shared(self, other: Box) -> Column:
        """Area of the intersection."""
        w = F.least(self.r, other.r) - F.greatest(self.l, other.l)
        h = F.least(self.b, other.b) - F.greatest(self.t, other.t)
        return F.when((w > 0) & (h > 0), w * h).otherwise(0.0)

    def inside(self, other: Box) -> Column:
        """Part of this box that lies in the other."""
        return F.when(self.area() > 0, self.shared(other) / self.area()).otherwise(0.0)

    def iou(self, other: Box) -> Column:
        both = self.shared(other)
        return F.when(self.area() + other.area() - both > 0, both / (self.area() + other.area() - both)).otherwise(0.0)

    def touches(self, other: Box) -> Column:
        """Closed boxes have a point in common."""
        return (self.l <= other.r) & (self.r >= other.l) & (self.t <= other.b) & (self.b >= other.t)

    def overlaps(self, other: Box) -> Column:
        """Open boxes have a point in common: what an equi-joined page has to be tested for first."""
        return (self.l < other.r) & (self.r > other.l) & (self.t < other.b) & (self.b > other.t)

    def grown(self, factor: float) -> Box:
        return Box(self.l - self.width * factor, self.t - self.height * factor, self.r + self.width * factor, self.b + self.height * factor)

    def scaled(self, x: float, y: float | None = None) -> Box:
        y = x if y is None else y
        return Box(self.l * x, self.t * y, self.r * x, self.b * y)

    def flipped(self, page_height: Column) -> Box:
        """The same box seen from the other vertical origin."""
        return Box(self.l, page_height - self.b, self.r, page_height - self.t)

    def rotated(self, angle: Column, page_width: Column, page_height: Column) -> Box:
        """The box after the page was turned counter-clockwise by ``angle`` (0, 90, 180 or 270 degrees)."""
        w, h = page_width, page_height
        turned = {0: self, 90: Box(self.t, w - self.r, self.b, w - self.l), 180: Box(w - self.r, h - self.b, w - self.l, h - self.t), 270: Box(h - self.b, self.l, h - self.t, self.r)}

        def pick(edge: str) -> Column:
            out = F.lit(None).cast("double")
            for a, box in turned.items():
                out = F.when(angle == a, getattr(box, edge)).otherwise(out)
            return out

        return Box(*map(pick, "ltrb"))

    def columns(self, prefix: str = "") -> list[Column]:
        return [getattr(self, x).alias(f"{prefix}{x}") for x in "ltrb"]
