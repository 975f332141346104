"""Best-fit packing of documents into token bins, improved by swap-based local search.

A document of n tokens fills n // capacity bins of its own; its last n % capacity tokens are
a piece that shares a bin.  Pieces are spread by hash into groups of about GROUP, each packed
by one task: best fit by falling size, then exchanges between underfull bins, each of which
increases the sum of squared fill, so that the emptiest bins run empty:

* move: a piece goes to the bin where it leaves the least room;
* one for one: a piece changes places with a smaller one of a fuller bin;
* two for one and one for two: the same with two pieces on either side.

The search ends at the least possible number of bins, or where no exchange from any bin to a
fuller one is left.  Groups are independent, so at most one bin or so of each stays underfull.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, row_keys, text_of
from tidemark.llm.curriculum import token_count

CAPACITY, GROUP = 2048, 4096


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in sizes; by falling size, each where it leaves the least room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        k = bisect_left(room, (sizes[i], -1))
        if k < len(room):
            free, b = room.pop(k)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        insort(room, (free - sizes[i], b))
    return bins


def _exchange(a: list[int], b: list[int], sizes: list[int], free: int) -> tuple[list[int], list[int]] | None:
    """The exchange that moves most tokens, at most `free`, from bin a to the fuller bin b: (out of a, out of b)."""
    best, most = None, 0
    ones = [([i], sizes[i]) for i in a]
    twos = [([a[x], a[y]], sizes[a[x]] + sizes[a[y]]) for x in range(len(a)) for y in range(x)]
    back = [([j], sizes[j]) for j in b]
    back2 = [([b[x], b[y]], sizes[b[x]] + sizes[b[y]]) for x in range(len(b)) for y in range(x)]
    for give, take in ((ones, [([], 0)]), (twos, [([], 0)]), (ones, back), (twos, back), (ones, back2)):
        take = sorted(take, key=lambda x: x[1])
        keys = [n for _, n in take]
        for out, n in give:
            k = bisect_left(keys, n - free)
            if k < len(keys) and 0 < n - keys[k] <= free and n - keys[k] > most:
                best, most = (out, take[k][0]), n - keys[k]
                if most == free:
                    return best
    return best


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Passes over the bins, from the emptiest on, until the least possible number or a pass without any exchange."""
    bins = [list(b) for b in bins if b]
    least = -(-sum(sizes) // capacity)
    fill = lambda b: sum(sizes[i] for i in b)
    changed = True
    while changed and len(bins) > least:
        changed, stuck = False, []
        while len(bins) > 1 and len(bins) + len(stuck) > least:
            bins.sort(key=lambda b: (-fill(b), b))
            a = bins.pop()
            moved = False
            for b in bins:
                free = capacity - fill(b)
                if free and (found := _exchange(a, b, sizes, free)):
                    out, back = found
                    for i in out:
                        a.remove(i)
                    for j in back:
                        b.remove(j)
                    a += back
                    b += out
                    changed = moved = True
                    if not a:
                        break
            if a and moved:
                bins.append(a)
            elif a:
                stuck.append(a)
        bins += stuck
    return bins


def pack_group(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key").reset_index(drop=True)
        sizes = [int(x) for x in pdf["size"]]
        group = int(pdf["grp"].iloc[0])
        bins = sorted(sorted(b) for b in local_search(best_fit(sizes, capacity), sizes, capacity))
        ids, starts = pdf["doc_id"].tolist(), pdf["start"].tolist()
        return pd.DataFrame(
            {
                "bin": [f"g{group}-{k}" for k in range(len(bins))],
                "doc_ids": [[ids[i] for i in b] for b in bins],
                "starts": [[starts[i] for i in b] for b in bins],
                "sizes": [[sizes[i] for i in b] for b in bins],
                "tokens": [sum(sizes[i] for i in b) for b in bins],
            }
        )

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bin, doc_ids, starts, sizes, tokens): the bins, with the pieces of each: the document, its first
    token (from 0; a token is a run without white space) and the number of tokens.

    Every token of every row is in one bin.  Rows that share an id are packed each for itself; ids may be of any
    type.  Null, empty and blank texts and rows without an id have no piece; a long text fills bins of its own.
    Ties in size go by id.  An empty table gives no bins; other columns aren't read.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    # rows are keyed after their tokens are counted, so that no text is written
    k = row_keys(docs.select(F.col(f"`{id_col}`").alias("doc_id"), token_count(text_of(text_col)).alias("n")).where("doc_id IS NOT NULL"))
    rows = checkpointed(k.docs.select("doc_id", F.col(k.key).alias("key"), "n").where("n > 0"))
    full = rows.where(f"n >= {capacity}").withColumn("part", F.explode(F.expr(f"sequence(0, cast(n DIV {capacity} AS int) - 1)")))
    full = full.select(F.format_string("d%d-%d", "key", "part").alias("bin"), F.array("doc_id").alias("doc_ids"), F.array((F.col("part") * capacity).cast("long")).alias("starts"), F.array(F.lit(capacity).cast("long")).alias("sizes"), F.lit(capacity).cast("long").alias("tokens"))
    rest = rows.where(f"n % {capacity} > 0").selectExpr("doc_id", "key", f"n % {capacity} AS size", f"n - n % {capacity} AS start")
    groups = max(1, round(rest.count() / group))
    rest = rest.withColumn("grp", F.pmod(F.xxhash64("key"), F.lit(groups)))
    shared = rest.groupBy("grp").applyInPandas(pack_group(capacity), f"bin string, doc_ids array<{k.id_type}>, starts array<long>, sizes array<long>, tokens long")
    return full.unionByName(shared)
