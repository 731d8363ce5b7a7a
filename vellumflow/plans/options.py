"""Options as frozen values. Every one of them is read by the part of the library that it is named for."""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AcceleratorOptions:
    """Where a plugged-in model runs; plug-ins get ``resolved()``."""

    num_threads: int = field(default_factory=lambda: int(os.environ.get("OMP_NUM_THREADS", "4")))
    device: str = "auto"

    def __post_init__(self):
        if self.device.split(":")[0] not in ("auto", "cpu", "cuda", "mps"):
            raise ValueError(f"no device named {self.device}")

    def resolved(self, available: tuple[str, ...] = ("cpu",)) -> str:
        """The device asked for if it is there, else the processor; auto takes the first of cuda, mps and cpu."""
        kind = self.device.split(":")[0]
        if kind == "auto":
            return next((d + ":0" if d == "cuda" else d for d in ("cuda", "mps") if d in available), "cpu")
        return self.device if kind in available else "cpu"


def split_list(raw: str | None) -> tuple[str, ...] | None:
    """The parts of an option or environment value, between commas and semicolons; none of none."""
    return None if raw is None else tuple(re.split("[;,]", raw))


@dataclass(frozen=True)
class OcrOptions:
    bitmap_area_threshold: float = 0.05
    force_full_page_ocr: bool = False


@dataclass(frozen=True)
class LayoutOptions:
    create_orphan_clusters: bool = True
    keep_empty_clusters: bool = False
    skip_cell_assignment: bool = False


@dataclass(frozen=True)
class PipelineOptions:
    """What DocumentConverter does besides parsing. Each enrichment needs a plug-in of its name."""

    document_timeout: float | None = None
    allow_external_plugins: bool = False
    do_code_enrichment: bool = False
    do_formula_enrichment: bool = False
    do_picture_classification: bool = False
    do_picture_description: bool = False
    accelerator: AcceleratorOptions = field(default_factory=AcceleratorOptions)

    def enrichments(self) -> dict[str, str]:
        """The labels to enrich, by the name of the plug-in."""
        wanted = (("code", "code", self.do_code_enrichment), ("formula", "formula", self.do_formula_enrichment), ("picture_classification", "picture", self.do_picture_classification), ("picture_description", "picture", self.do_picture_description))
        return {name: label for name, label, on in wanted if on}

    def key(self) -> str:
        """The name under which a pipeline with these options is kept."""
        return hashlib.md5(repr(sorted(asdict(self).items())).encode(), usedforsecurity=False).hexdigest()


def options_key(options: Column) -> Column:
    """The same for options that are a struct column."""
    return F.md5(F.to_json(options))
