"""Small helpers shared by the tests."""

import contextlib
import io
import time


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def shuffle_blocks(spark):
    """Names of the shuffle files on the local disks, of this session's jobs so far."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(k).name() for k in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_after(spark, before):
    """Shuffle files that have come since and stay: they are dropped a moment after a write."""
    for _ in range(50):
        if not (left := shuffle_blocks(spark) - before):
            break
        time.sleep(0.1)
    return left
