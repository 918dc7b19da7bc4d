"""Staged execution: every stage output is written, recorded and read back.

A tool is a list of ``Stage``s.  ``compose`` chains them lazily; ``run`` writes
each output to a store, so that it is computed once however many later stages
read it, and a rerun goes on after the last complete stage.  A stage that only
projects its input (``stored=False``) is not written but read through.  What a stage was
made from is recorded with it: its arguments and the versions of its inputs.  A
stage is skipped when its output is complete and both are unchanged; once one
is made anew, everything that reads it is.

Volumes (``x, y, z``) are stored block-addressed, tables as plain Parquet; both
are claimed in the ledger before the write and completed after it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import ledger as led
from ..sources import volume


@dataclass
class Stage:
    """``build(*inputs)`` makes ``name`` from earlier stages or given frames, named by ``needs``.

    ``unique_ids``: labels that must not touch themselves across a block face (J8), held to it by their own write.
    """

    name: str
    needs: tuple
    build: Callable[..., DataFrame]
    args: dict = field(default_factory=dict)
    stored: bool = True
    unique_ids: bool = False


def new_store(spark: SparkSession, kind: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def compose(stages: list[Stage], given: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All stages as lazy frames; loops inside a stage run while it is built."""
    made = dict(given)
    for s in stages:
        made[s.name] = s.build(*[made[n] for n in s.needs])
    return {s.name: made[s.name] for s in stages}


def needed(stages: list[Stage], wanted) -> list[Stage]:
    """The stages that the ``wanted`` outputs are made from, in order."""
    keep = set(wanted)
    for s in reversed(stages):
        if s.name in keep:
            keep |= set(s.needs)
    return [s for s in stages if s.name in keep]


def _digest(args: dict) -> str:
    return hashlib.sha256(json.dumps(args, sort_keys=True, default=str).encode()).hexdigest()[:16]


def _is_volume(df: DataFrame) -> bool:
    return {"x", "y", "z"} <= set(df.columns)


def table_path(path: str, name: str, level: int = 0) -> str:
    return f"{path}-tables/{name}/level={int(level)}"


def read_output(spark: SparkSession, path: str, name: str, level: int = 0, row=None) -> DataFrame:
    """A complete output of a store, volume or table."""
    row = row or led.Ledger(spark, path).require_complete(name, level)
    if (row["attrs"] or {}).get("kind") == "table":
        return spark.read.parquet(table_path(path, name, level))
    if row["rows"] == 0:
        return led.no_rows(spark, row)
    return volume.read_volume(spark, path, name, level)


def write_output(ledger: led.Ledger, df: DataFrame, path: str, name: str, block_size, level: int = 0, args: dict | None = None,
                 dims=None, attrs: dict | None = None, **claim):
    """One output under a claim; returns its ledger row."""
    if _is_volume(df):
        return led.write_volume(ledger, df, path, name, level, block_size, dims, args=args,
                                attrs=(attrs or {}) | {"kind": "volume"}, **claim)
    claimed = ledger.claim(name, level, block_size, "struct", dims or (0, 0, 0), args=args, attrs={"kind": "table"}, **claim)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(table_path(path, name, level))
    return ledger.complete(claimed, dims, rows=seen.get["rows"], attrs=(attrs or {}) | {"kind": "table"})


def run(spark: SparkSession, path: str, stages: list[Stage], given: dict[str, DataFrame], block_size, dims=None,
        args: dict | None = None, overwrite: bool = False, wanted: tuple | None = None) -> dict[str, DataFrame]:
    """Run the stages that are not complete yet; returns every stage's stored output.

    ``wanted``: only these outputs and what they need.

    ``args`` say what the given frames are (they can't be compared themselves):
    a run with other arguments makes everything anew.
    """
    ledger = led.Ledger(spark, path)
    if wanted is not None:
        stages = needed(stages, wanted)
    # the state of this tool's outputs: one row per stage
    names = [s.name for s in stages]
    rows = {r["dataset"]: r for r in ledger.latest().filter(F.col("dataset").isin(names) & (F.col("level") == 0)).collect()}
    made: dict[str, DataFrame] = dict(given)
    versions: dict[str, str] = {}
    for s in stages:
        told = {"args": _digest({"tool": args or {}, "stage": s.args}), **{f"from:{n}": versions[n] for n in s.needs if n in versions}}
        if not s.stored:
            made[s.name] = s.build(*[made[n] for n in s.needs])
            versions[s.name] = " ".join([told.pop("args"), *told.values()])
            continue
        old = rows.get(s.name)
        same = old is not None and old["status"] == "complete" and all((old["attrs"] or {}).get(k) == v for k, v in told.items())
        if overwrite or not same:
            df = s.build(*[made[n] for n in s.needs])
            rows[s.name] = write_output(ledger, df, path, s.name, block_size, args={**(args or {}), **s.args}, dims=dims,
                                        attrs=told, known=old, **({"unique_ids": True} if s.unique_ids else {}))
        versions[s.name] = str(rows[s.name]["version"])
        made[s.name] = read_output(spark, path, s.name, row=rows[s.name])
    return {n: made[n] for n in names}
