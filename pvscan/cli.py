"""Command line: one command for each stage, and run-all."""

from __future__ import annotations

import argparse
import json
import logging

from pvscan.config import load_config

COMMANDS = {
    "aoi": ("boundary and tiles", ()),
    "labels": ("solar labels", ()),
    "composite": ("cloud-free composites", ("tiles",)),
    "buildings": ("large buildings", ()),
    "chips": ("training chips and splits", ("tiles",)),
    "pack-chips": ("number chips for readers by position", ()),
    "train": ("fit the pixel model", ("run_id",)),
    "clean-negatives": ("mark negatives that look like solar", ("run_id", "model_ckpt")),
    "embed-screen": ("candidate windows from embeddings", ("tiles",)),
    "infer": ("score windows with buildings", ("run_id", "tiles", "model_ckpt")),
    "postprocess": ("predicted solar, statistics, what the map lacks", ("run_id",)),
    "report": ("the map", ("run_id",)),
    "validate": ("metrics and counts against the map", ("run_id",)),
    "run-all": ("all stages", ("run_id",)),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pvscan")
    sub = top.add_subparsers(dest="command", required=True)
    for name, (about, options) in COMMANDS.items():
        p = sub.add_parser(name, help=about)
        p.add_argument("--config", "-c", required=True)
        p.add_argument("--inputs", default="inputs", help="folder of source tables and cached responses")
        if "tiles" in options:
            p.add_argument("--tiles", type=lambda s: [t.strip() for t in s.split(",")])
        if "run_id" in options:
            p.add_argument("--run-id")
        if "model_ckpt" in options:
            p.add_argument("--model-ckpt")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    from pyspark.sql import SparkSession

    from pvscan.plans import stages

    cfg = load_config(args.config)
    r = stages.Region(SparkSession.builder.appName(f"pvscan-{cfg.region}").getOrCreate(), cfg, args.inputs)
    run_id, tiles, model = (getattr(args, n, None) for n in ("run_id", "tiles", "model_ckpt"))
    calls = {
        "aoi": lambda: stages.aoi(r),
        "labels": lambda: stages.make_labels(r),
        "composite": lambda: stages.composite(r, tiles),
        "buildings": lambda: stages.buildings(r),
        "chips": lambda: stages.chips(r, tiles),
        "pack-chips": lambda: stages.pack_chips(r),
        "train": lambda: stages.train(r, run_id),
        "clean-negatives": lambda: stages.clean_negatives(r, run_id, model),
        "embed-screen": lambda: stages.embed_screen(r, tiles),
        "infer": lambda: stages.infer(r, run_id, tiles, model),
        "postprocess": lambda: stages.finish(r, run_id),
        "report": lambda: print(stages.report(r, run_id)),
        "validate": lambda: print(json.dumps(stages.validate(r, run_id), indent=2)),
        "run-all": lambda: print(stages.run_all(r, run_id)),
    }
    calls[args.command]()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
