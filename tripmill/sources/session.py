"""Session settings that depend on the size of the input, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

MIB = 1024 * 1024

# A map side above this many tasks makes the driver's shuffle bookkeeping the bottleneck.
_MAX_SCAN_TASKS = 200_000
_MAX_SHUFFLE_PARTITIONS = 40_000
_SHUFFLE_TARGET = 256 * MIB


@contextmanager
def sql_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply SQL settings for the length of a block and put the old values back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def sized_settings(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Scan split size and shuffle width for a job that reads ``input_bytes``.

    Splits grow from 128 MiB to 512 MiB so that a 100 TB scan stays near 200,000 tasks;
    only a few columns of each split are decoded, and the copies inside one split are
    collapsed in memory before the shuffle, so a split must not grow without bound. The
    shuffle gets one partition per 256 MiB of input, never fewer than the session asks
    for; adaptive execution merges what turns out small.
    """
    split = min(512 * MIB, max(128 * MIB, input_bytes // _MAX_SCAN_TASKS))
    wanted = min(_MAX_SHUFFLE_PARTITIONS, -(-input_bytes // _SHUFFLE_TARGET))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(max(current, wanted)),
    }


def monthly_settings(months: int) -> dict[str, str]:
    """For writing tables partitioned by month straight out of the dedupe shuffle.

    Rows are spread by their hash, so every task holds a bit of every month, however
    uneven the months are. Tasks take on a normal file's worth of rows per month, and write
    all months (12 at most) side by side instead of sorting by month first. Gathering each
    month in its own tasks would cost a second shuffle of everything.
    """
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(8, months) * 64 * MIB),
        "spark.sql.maxConcurrentOutputFileWriters": "12",
    }


def in_parallel(spark: SparkSession, jobs: Sequence[Callable[[], Any]]) -> list[Any]:
    """Submit independent jobs side by side, so that one's tail does not idle the cluster."""
    call = inheritable_thread_target(spark)(lambda job: job())
    with ThreadPoolExecutor(max(1, min(8, len(jobs)))) as pool:
        return list(pool.map(call, jobs))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a session that runs
    on this machine alone may leave it unset and gets a folder here.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tripmill-")
    app = spark.sparkContext.applicationId
    return f"{shared.rstrip('/')}/tripmill/{app}/{purpose}-{uuid.uuid4().hex}"
