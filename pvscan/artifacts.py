"""A region's artifacts: places, freshness, the composite catalogue, GeoJSON and the map."""

from __future__ import annotations

import contextlib
import html
import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: Features drawn in a layer of the map.
MOST_FEATURES = 5000


class Store:
    """Where a region's tables lie. Tables are Parquet folders; small files are JSON."""

    def __init__(self, root: str | Path) -> None:
        self.root = Path(root)

    def table(self, *parts: str) -> Path:
        return self.root.joinpath(*parts[:-1], parts[-1] + ".parquet")

    def output(self, run_id: str, name: str) -> Path:
        return self.root / "outputs" / run_id / name

    def model(self, run_id: str) -> Path:
        return self.root / "models" / run_id


def _sidecar(artifact: Path) -> Path:
    hidden = "." if "=" in artifact.name else ""  # beside a partition, where Spark would read it
    return artifact.with_name(f"{hidden}{artifact.name}.meta.json")


def _state(path: Path) -> str:
    """Size and time of a file, or of all files of a folder."""
    files = sorted(p for p in path.rglob("*") if p.is_file()) if path.is_dir() else [path]
    return f"{sum(p.stat().st_size for p in files)}:{max((p.stat().st_mtime_ns for p in files), default=0)}"


def _plain(value: dict) -> dict:
    return json.loads(json.dumps(value, sort_keys=True, default=str))


def write_meta(artifact: Path, settings: dict, inputs: list[Path] = ()) -> None:
    meta = {"config": _plain(settings), "inputs": {str(p): _state(p) for p in inputs if p.exists()}, "written_at": time.strftime("%Y-%m-%dT%H:%M:%S%z")}
    _sidecar(artifact).write_text(json.dumps(meta, indent=2, sort_keys=True))


def is_fresh(artifact: Path, settings: dict, inputs: list[Path] = ()) -> bool:
    """Artifact and sidecar exist, settings are equal, and inputs that still exist are as recorded; a new input makes it stale."""
    try:
        meta = json.loads(_sidecar(artifact).read_text())
    except (OSError, ValueError):
        return False
    if not artifact.exists() or meta.get("config") != _plain(settings):
        return False
    now = {str(p): _state(p) for p in inputs if p.exists()}
    return {k: v for k, v in meta.get("inputs", {}).items() if k in now} == now


def write_json(value: object, path: Path) -> None:
    """Written beside its place, then renamed onto it."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{os.getpid()}")
    part.write_text(json.dumps(value, indent=2, sort_keys=True))
    part.replace(path)


def read_json(path: Path) -> object:
    return json.loads(path.read_text())


@contextlib.contextmanager
def locked(path: Path, patience: float = 60.0):
    """Holds a file's lock, a file of its own beside it; of two writers the second waits. TimeoutError after ``patience`` seconds."""
    lock = path.with_name(f".{path.name}.lock")
    lock.parent.mkdir(parents=True, exist_ok=True)
    end = time.monotonic() + patience
    while True:
        try:
            os.close(os.open(lock, os.O_CREAT | os.O_EXCL))
            break
        except FileExistsError:
            if time.monotonic() > end:
                raise TimeoutError(f"{lock} is held by another writer") from None
            time.sleep(0.02)
    try:
        yield
    finally:
        lock.unlink(missing_ok=True)


def register_composite(catalogue: Path, tile: str, range_idx: int, **properties: object) -> bool:
    """Adds or replaces an item by tile and range, under a lock; returns whether anything changed. A catalogue that can't be read is begun anew."""
    with locked(catalogue):
        try:
            items = read_json(catalogue)
            items = items if isinstance(items, dict) else {}
        except (OSError, ValueError):
            items = {}
        key, item = f"{tile}_range{range_idx}", _plain({"tile": tile, "range_idx": range_idx, **properties})
        if items.get(key) == item:
            return False
        write_json(items | {key: item}, catalogue)
        return True


def composites(spark: SparkSession, catalogue: Path) -> DataFrame:
    items = list(read_json(catalogue).values()) if catalogue.exists() else []
    rows = [(i["tile"], int(i["range_idx"]), json.dumps(i, sort_keys=True)) for i in items]
    return spark.createDataFrame(rows, "tile string, range_idx int, item string")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both; where keys meet, the new ones."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def replace_tiles(old: DataFrame, new: DataFrame, tile: str = "tile") -> DataFrame:
    return upsert(old, new, [tile])


def packed(chips: DataFrame, order: list[str]) -> DataFrame:
    """Chips with an explicit row number ``h5_row`` (from 0) in a total order, for readers by position."""
    from pvscan.operators.labels import with_building_id

    keep = [c for c in chips.columns if c != "building_id"]
    return with_building_id(chips.select(*keep), order).withColumnRenamed("building_id", "h5_row")


def features(df: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature (text) for each box."""
    corner = lambda x, y: F.array(F.col(x).cast("double"), F.col(y).cast("double"))
    ring = F.array(corner("x1", "y1"), corner("x2", "y1"), corner("x2", "y2"), corner("x1", "y2"), corner("x1", "y1"))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))


def write_geojson(df: DataFrame, path: Path, properties: list[str]) -> None:
    """A feature collection in one file; rows are streamed through the driver, never held together."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w") as out:
        out.write('{"type":"FeatureCollection","features":[')
        for k, row in enumerate(features(df, properties).toLocalIterator()):
            out.write(("," if k else "") + "\n" + row[0])
        out.write("\n]}\n")


def build_map(layers: dict[str, tuple[DataFrame, list[str]]], path: Path, title: str) -> None:
    """A static page with the first 5000 boxes of each layer, in the layer's order (the limit is the page's)."""
    data = {}
    for name, (df, properties) in layers.items():
        shown = [p for p in properties if p in df.columns]
        data[name] = [json.loads(r[0]) for r in features(df.limit(MOST_FEATURES), shown).collect()]
    path.parent.mkdir(parents=True, exist_ok=True)
    script = "const c=document.querySelector('canvas'),g=c.getContext('2d');let a=[1/0,1/0,-1/0,-1/0];const all=Object.values(data).flat().flatMap(f=>f.geometry.coordinates[0]);for(const [x,y] of all){a=[Math.min(a[0],x),Math.min(a[1],y),Math.max(a[2],x),Math.max(a[3],y)]}const s=Math.min(c.width/(a[2]-a[0]||1),c.height/(a[3]-a[1]||1));Object.values(data).forEach((fs,i)=>{g.strokeStyle=['#888','#06c','#0a0','#d00'][i%4];for(const f of fs){g.beginPath();f.geometry.coordinates[0].forEach(([x,y])=>g.lineTo((x-a[0])*s,c.height-(y-a[1])*s));g.stroke()}})"
    legend = "".join(f"<li>{html.escape(n)}: {len(fs)}</li>" for n, fs in data.items())
    path.write_text(f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><ul>{legend}</ul><canvas width=1200 height=900></canvas><script>const data={json.dumps(data).replace('</', '<\\/')};{script}</script>")


def numbered_batches(df: DataFrame, order: list, size: int) -> DataFrame:
    """Adds batch: rows in order, ``size`` to a batch; for lists that fit one task, such as cells or tiles."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / size))
