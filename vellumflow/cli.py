"""python -m vellumflow.cli SOURCE --output FOLDER [--from FORMAT ...] [--to md json html html_split_page text doctags outline]: converts files."""

from __future__ import annotations

import argparse
import sys

from vellumflow.plans.convert import DocumentConverter, Limits
from vellumflow.plans.options import split_list


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("source")
    p.add_argument("--output", required=True)
    p.add_argument("--from", dest="formats", nargs="*")
    p.add_argument("--to", nargs="*", default=["md"], choices=["md", "json", "html", "html_split_page", "text", "doctags", "outline"])
    p.add_argument("--max-file-size", type=int)
    p.add_argument("--max-pages", type=int)
    p.add_argument("--abort-on-error", action="store_true")
    o = p.parse_args(args)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    limits = Limits(max_num_pages=o.max_pages, max_file_size=o.max_file_size)
    result = DocumentConverter(spark, tuple(f for x in o.formats for f in split_list(x)) if o.formats else None).convert_all(o.source, limits, raises_on_error=o.abort_on_error)
    counts = {r["status"]: r["count"] for r in result.export(o.output, tuple(o.to)).collect()}
    print(", ".join(f"{n} {s}" for s, n in sorted(counts.items())) or "nothing found")
    return int(any(s != "success" for s in counts))


if __name__ == "__main__":
    sys.exit(main())
