"""Best-fit packing of documents into sequences, with conflicts.

A document longer than a sequence fills sequences of its own; its rest is packed. Rests
are placed from the longest to the shortest. Open bins stand in order of
their free room, each with a bitmap of the sources and one of the duplicate clusters it
holds. From the first bin with enough room the search goes on to the next larger
one until a bin holds neither the source nor the cluster: the tightest
compatible bin. Without one a bin is opened.

Documents are dealt to groups of about ``GROUP`` by a hash of the id, packed one group at
a time, so a task holds one group whatever the size of the table, and a hot
source or cluster is spread over all groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import saved, words

CAPACITY = 1024
GROUP = 4096
SCHEMA = "doc_id long, piece long, start long, n_tokens long, bin string, offset long"


def _bits(values) -> list[int]:
    """A bit for each different value; none for null."""
    place: dict = {}
    return [0 if v is None or v != v else 1 << place.setdefault(v, len(place)) for v in values]


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item; ``sources`` and ``clusters`` hold one bit each, or 0."""
    rooms: list[tuple[int, int]] = []  # (free room, bin), ascending
    held: list[list[int]] = []  # of each bin: sources, clusters
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need, source, cluster = lengths[item], sources[item], clusters[item]
        at = bisect_left(rooms, (need, -1))
        while at < len(rooms) and (held[rooms[at][1]][0] & source or held[rooms[at][1]][1] & cluster):
            at += 1
        if at < len(rooms):
            room, chosen = rooms.pop(at)
        else:
            room, chosen = capacity, len(held)
            held.append([0, 0])
        held[chosen][0] |= source
        held[chosen][1] |= cluster
        bins[item], offsets[item] = chosen, capacity - room
        if room > need:
            insort(rooms, (room - need, chosen))
    return bins, offsets


def _pack_rows(name: str, rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one group's documents, in order of the documents."""
    rows = rows.sort_values(["n", "doc_id"], ascending=[False, True], kind="stable", ignore_index=True)
    lengths = rows["n"].tolist()
    rest = [n % capacity for n in lengths]
    own = [i for i, n in enumerate(rest) if n]
    sources, clusters = _bits(rows["source"]), _bits(rows["cluster"])
    bins, offsets = best_fit([rest[i] for i in own], [sources[i] for i in own], [clusters[i] for i in own], capacity)
    placed = dict(zip(own, zip(bins, offsets)))
    used = max(bins, default=-1) + 1
    out = []
    for i, (doc, n) in enumerate(zip(rows["doc_id"].astype(object).where(rows["doc_id"].notna(), None), lengths)):
        for piece in range(n // capacity):
            out.append((doc, piece, piece * capacity, capacity, f"{name}-{used}", 0))
            used += 1
        if i in placed:
            out.append((doc, n // capacity, n - rest[i], rest[i], f"{name}-{placed[i][0]}", placed[i][1]))
    frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "n_tokens", "bin", "offset"])
    return frame.astype({"doc_id": "Int64"})


def _packed(capacity: int, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by group; a group beyond ``size`` rows is packed in parts of that many."""
        group, part, waiting = None, 0, []
        def flush():
            return _pack_rows(f"{group}-{part}", pd.concat(waiting, ignore_index=True), capacity)
        for batch in batches:
            for key, rows in batch.groupby("grp", sort=False):
                if key != group:
                    if waiting:
                        yield flush()
                    group, part, waiting = key, 0, []
                while len(rows):
                    room = size - sum(map(len, waiting))
                    waiting.append(rows.iloc[:room])
                    rows = rows.iloc[room:]
                    if len(rows):
                        yield flush()
                        part, waiting = part + 1, []
        if waiting:
            yield flush()
    return run


def packed(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Pieces (doc_id, piece, start, n_tokens, bin, offset) of rows (doc_id, n, source, cluster).

    ``start`` counts from the document's first token, ``offset`` from the bin's. No bin holds two
    rows of one source or of one cluster; a null one conflicts with nothing. Rows without
    tokens (n null or below 1) have no piece. Repeated rows are packed each; null
    ids stay null. An empty table gives an empty result.
    """
    items = items.select("doc_id", F.col("n").cast("long").alias("n"), "source", F.col("cluster").cast("string").alias("cluster")).filter("n > 0")
    items = saved(items, "pack-items")
    groups = max(1, -(-items.count() // (group * 9 // 10)))
    dealt = items.withColumn("grp", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(groups)))
    tasks = min(groups, max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), groups // 64))
    ordered = dealt.repartition(tasks, "grp").sortWithinPartitions("grp", "doc_id", "n", "source", "cluster")
    return ordered.mapInPandas(_packed(capacity, 2 * group), SCHEMA)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """:func:`packed` for documents: a token is a word, and each document ends with one more. Equal texts are a cluster.

    Null texts count as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return packed(docs.select("doc_id", (words("text") + 1).alias("n"), "source", F.xxhash64(text).alias("cluster")), capacity)
