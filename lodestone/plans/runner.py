"""Layers run in order with a manifest; channels run apart from each other."""

from __future__ import annotations

import copy
import hashlib
import json
import os
import platform
import time
from collections.abc import Callable

import pyspark
from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import write_json


def check_config(config: dict, required: list[str], known: list[str]) -> dict:
    """``config`` if it has all required keys and no unknown one."""
    missing, unknown = sorted(set(required) - set(config)), sorted(set(config) - set(known))
    if missing or unknown:
        raise ValueError(f"missing keys {missing}, unknown keys {unknown}")
    return config


def config_digest(config: dict, machine: tuple[str, ...] = ("paths",)) -> str:
    """SHA-256 of the sorted settings without those that name places on one machine."""
    kept = {k: v for k, v in config.items() if k not in machine}
    return hashlib.sha256(json.dumps(kept, sort_keys=True).encode()).hexdigest()


def environment(spark: SparkSession) -> dict:
    return {"python": platform.python_version(), "pyspark": pyspark.__version__, "time_zone": spark.conf.get("spark.sql.session.timeZone")}


def run_channels(spark: SparkSession, channels: dict[str, Callable[[SparkSession, dict], DataFrame]], enabled: dict[str, bool], config: dict, out: str) -> dict:
    """Each enabled channel's table as Parquet; a failure is recorded and stops no other.

    The toggles must name the registry exactly.  An empty table is a failure.
    """
    if set(enabled) != set(channels) or not all(isinstance(v, bool) for v in enabled.values()):
        raise ValueError("the toggles do not match the channels")
    status = {}
    for name in sorted(channels):
        if not enabled[name]:
            status[name] = {"status": "disabled"}
            continue
        try:
            table = channels[name](spark, copy.deepcopy(config))
            table.write.mode("overwrite").parquet(f"{out}/{name}")
            n = spark.read.parquet(f"{out}/{name}").count()
            status[name] = {"status": "complete", "rows": n} if n else {"status": "failed", "error": "the table is empty"}
        except Exception as e:  # recorded, so that the other channels still run
            status[name] = {"status": "failed", "error": f"{type(e).__name__}: {e}"[:500]}
    return status


def run_layers(spark: SparkSession, layers: dict[str, Callable[[SparkSession, dict], dict]], config: dict, manifest: str, resume: bool = False, only: str | None = None) -> dict:
    """Runs layers in order; the manifest is written after each, before an error goes on."""
    done = {}
    if resume and os.path.exists(manifest):
        with open(manifest, encoding="utf-8") as f:
            done = json.load(f)["layers"]
    record = {"config": config_digest(config), "environment": environment(spark), "layers": done}
    for name, layer in layers.items():
        if (only and name != only) or (resume and done.get(name, {}).get("status") == "complete"):
            continue
        began = time.time()
        try:
            done[name] = {"status": "complete", **(layer(spark, config) or {}), "seconds": round(time.time() - began, 3)}
        except NotImplementedError as e:
            done[name] = {"status": "not_implemented", "error": str(e)}
            write_json(manifest, record)
            break
        except Exception as e:
            done[name] = {"status": "failed", "error": f"{type(e).__name__}: {e}"[:500]}
            write_json(manifest, record)
            raise
        write_json(manifest, record)
    return record
