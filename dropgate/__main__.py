"""Command line: run the registries over a folder of input files.

    python -m dropgate --input data/input --root data/preboarding \\
        --catalog catalog.yaml [--steps steps.yaml] [--backup data/backup] \\
        [--run-id 20250101_000000] [--delivery-format parquet|csv] [--clear-input] \\
        [--restore-from RUN]

``catalog.yaml`` maps table names to specs, e.g.::

    static.mappings.product_mapping: {path: data/static/product_mapping.csv, format: csv, required: true}
    static.mappings.inventory_snapshot: {path: data/static/inventory_snapshot, versioned: true}

``steps.yaml`` (optional) is a list of ``[name, kind, registry file]``;
by default the shipped steps 0-5 run. Prints one summary line per step and
exits non-zero when a step failed for every file.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

import yaml


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="dropgate", description=__doc__.splitlines()[0])
    ap.add_argument("--input", help="folder of input files (or --restore-from)")
    ap.add_argument("--root", required=True, help="folder for staging, findings and delivery")
    ap.add_argument("--catalog", help="YAML file: table name -> {path, format, required, versioned}")
    ap.add_argument("--steps", help="YAML file: list of [name, kind, registry file]")
    ap.add_argument("--backup")
    ap.add_argument("--restore-from", help="take the input from this run of --backup (a run id, or -1 for the latest)")
    ap.add_argument("--no-quoted-line-breaks", action="store_true",
                    help="no CSV value has a line break, so large files can be split")
    ap.add_argument("--run-id")
    ap.add_argument("--sep", default=";")
    ap.add_argument("--delivery-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--case-sensitive", action="store_true")
    ap.add_argument("--clear-input", action="store_true")
    ap.add_argument("--master", help="Spark master (default: the cluster's / local[*])")
    args = ap.parse_args(argv)
    if not args.input and not (args.restore_from and args.backup):
        ap.error("give --input, or --restore-from with --backup")

    from dropgate.plans.stages import Preboarding
    from dropgate.registries import default_steps
    from dropgate.session import get_spark
    from dropgate.sources.catalog import Catalog

    spark = get_spark(args.master)
    tables = {}
    if args.catalog:
        with open(args.catalog, encoding="utf-8") as fh:
            tables = yaml.safe_load(fh) or {}
    if args.steps:
        with open(args.steps, encoding="utf-8") as fh:
            base = os.path.dirname(os.path.abspath(args.steps))
            steps = [(n, k, r if os.path.isabs(r) else os.path.join(base, r)) for n, k, r in yaml.safe_load(fh)]
    else:
        steps = default_steps()
    pb = Preboarding(spark, args.root, catalog=Catalog(spark, tables), run_id=args.run_id,
                     case_sensitive=args.case_sensitive, sep=args.sep, delivery_format=args.delivery_format,
                     multiline=not args.no_quoted_line_breaks)
    outs = pb.run(args.input, steps, backup_root=args.backup, clear_input=args.clear_input, restore_from=args.restore_from)
    for o in outs:
        print(json.dumps({"run_id": pb.run_id, "step": o.step, **o.summary, "sec": pb.timings.get(o.step)}))
    complete = len(outs) == len(steps) and all(o.summary["passed"] for o in outs)
    return 0 if complete else 1


if __name__ == "__main__":
    sys.exit(main())
