"""Connected components of a link table too large for one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import saved


def local_roots(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """Smallest index reachable from each of ``size`` nodes over the links ``left[i] - right[i]``."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def components(links: DataFrame) -> DataFrame:
    """Smallest member (``root``) of the component of every ``node``.

    ``links`` has longs ``node`` > ``root``, with repeats allowed; nodes that are
    the smallest of their component are not listed in the result. Each round
    points every link of a node at the least of its ends, then takes one step
    towards the root, so long chains shorten by half. Only links move, by
    aggregates and joins; each round is written out, and the loop ends when
    a round changes nothing.
    """
    links = saved(links.select("node", "root").distinct(), "links")
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return links
        before = mark
        least = links.groupBy("node").agg(F.min("root").alias("least"))
        other = links.join(least, "node").filter("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        stars = least.select("node", F.col("least").alias("root")).unionByName(other).distinct()
        onward = stars.groupBy(F.col("node").alias("root")).agg(F.min("root").alias("next"))
        moved = stars.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        links = saved(moved.distinct(), "links")
