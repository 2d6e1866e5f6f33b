"""Command line: import-osm, import-kml, select and prefetch."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..dims import REGIONS, Classes
from ..operators import encode, tiler
from ..sources.store import open_store
from . import jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera", description=__doc__)
    add = top.add_subparsers(dest="job", required=True)
    a = add.add_parser("import-osm", help="a new store from a map file")
    for name in ("style", "map", "store"):
        a.add_argument(name)
    a.add_argument("--classes", help="class dictionary: one key:value a line")
    a.add_argument("--lenient", action="store_true", help="pass over unknown elements")
    a = add.add_parser("import-kml", help="boundary files added to a store")
    for name in ("style", "store"):
        a.add_argument(name)
    a.add_argument("files", nargs="+")
    a.add_argument("--classes")
    a = add.add_parser("select", help="one tile: its file, a text dump and a picture")
    for name in ("store", "request", "out"):
        a.add_argument(name)
    a = add.add_parser("prefetch", help="all tiles of a region")
    a.add_argument("region", choices=sorted(REGIONS))
    for name in ("store", "out"):
        a.add_argument(name)
    a.add_argument("--empty", action="store_true", help="tiles that hold nothing too")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    classes = Classes.read(spark, args.classes) if getattr(args, "classes", None) else None
    if args.job == "import-osm":
        jobs.import_osm(spark, args.style, args.map, args.store, classes=classes, strict=not args.lenient)
    elif args.job == "import-kml":
        jobs.import_kml(spark, args.style, args.store, args.files, classes)
    elif args.job == "prefetch":
        jobs.prefetch(open_store(spark, args.store), args.out, args.region, empty=args.empty)
    else:
        tile = jobs.serve(open_store(spark, args.store), args.request).persist()
        encode.write_files(encode.encode_tiles(tile), args.out)
        for r in tiler.text_dump(tile).orderBy("line_no").collect():
            print(r.line)
        dots = [(p.kind, p.px, p.py) for p in tiler.pixels(tile).collect()]
        row = spark.createDataFrame([("tile.png", bytearray(encode.picture(dots)))], "name string, data binary")
        row.write.mode("overwrite").parquet(f"{args.out}/picture")
    return 0


if __name__ == "__main__":
    sys.exit(main())
