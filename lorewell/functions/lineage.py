"""Cutting the lineage of driver loops."""

from __future__ import annotations

import re
import tempfile
from functools import cache

from pyspark.sql import DataFrame


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="lineage-")


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder that spark.checkpoint.dir names; a local session, as in tests, may do without."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or _own_folder())
    return df.checkpoint(eager=True)
