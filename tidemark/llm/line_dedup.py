"""Line dedup by pairwise alignment.

1. Each text becomes its sequence of line hashes; from then on texts stay where they are.
2. Every run of consecutive lines that just reaches LEAST_BLOCK bytes (one line, where lines are
   long; many, where they are short) is keyed by its hash.  Keys are counted and their first
   holder found with partial aggregation; a key that one document holds goes no further.
3. Documents are paired through rare keys (at most RARE holders), later with the first earlier
   holder, and each pair is aligned with patience diff: lines unique in both ranges are matched
   along their longest increasing subsequence, equal heads and tails are matched, and the gaps in
   between are aligned in turn.  Matched lines that are consecutive in both texts form blocks;
   those of at least LEAST_BLOCK bytes are deleted from the later text.
4. Alignment alone can't give whole results: pairs with all earlier holders would be quadratic,
   and a patience match misses blocks in another order and lines that occur twice.  So every run
   of step 2 that any earlier document holds is deleted too, common or rare.  Every block that
   alignment with any earlier document could find is a union of such runs, so all holders count,
   at a cost linear in the lines.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit as tk
from tidemark.llm.common import checkpointed, fresh, row_keys, text_of

RARE, LEAST_BLOCK = 8, 50


def line_sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in tk.chunked(batch.column(1)):
            doc, _, size, h = tk.lines_of(texts)
            cuts = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(texts)), pa.ListArray.from_arrays(cuts, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(cuts, pa.array(size.astype(np.int32)))],
                ["id", "hashes", "sizes"],
            )


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of two sequences, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        na, nb = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        place = {x: j for j, x in enumerate(b[blo:bhi], blo) if nb[x] == 1}
        both = [(i, place[x]) for i, x in enumerate(a[alo:ahi], alo) if na[x] == 1 and x in place]
        if not both:
            continue
        ends, at, back = [], [], [-1] * len(both)
        for k, (_, j) in enumerate(both):
            p = bisect_left(ends, j)
            back[k] = at[p - 1] if p else -1
            ends[p : p + 1] = [j]
            at[p : p + 1] = [k]
        k, chain = at[-1], []
        while k >= 0:
            chain.append(both[k])
            k = back[k]
        out += chain
        i0, j0 = alo, blo
        for i, j in reversed(chain):
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, ahi, j0, bhi))
    return sorted(out)


def deletable(later: list, sizes: list, earlier: list, least_block: int) -> list[int]:
    """Line numbers of the later text in blocks of at least least_block bytes."""
    out: list[int] = []
    block: list[int] = []
    last = None
    for i, j in [*patience(later, earlier), (-9, -9)]:
        if last and (i, j) == (last[0] + 1, last[1] + 1):
            block.append(i)
        else:
            if block and sum(sizes[k] for k in block) >= least_block:
                out += block
            block = [i]
        last = (i, j)
    return out


def _align(least_block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, start = [], []
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                for i, a, s, b in zip(*(c.to_pylist() for c in part.columns)):
                    for k in deletable(a, s, b, least_block):
                        ids.append(i)
                        start.append(k)
            at = pa.array(start, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), at, pa.array(np.array(start, np.int32) + np.int32(1))], ["id", "start", "stop"])

    return run


def run_rows(least_block: int):
    """Sequences -> (key, id, start, stop): the runs of lines that reach least_block bytes and are minimal
    from their first line on or up to their last one."""
    inverse = np.uint64(pow(int(tk._MULT), -1, 1 << 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                lines = part.column(1).value_lengths().to_numpy()
                n = int(lines.sum())
                if not n:
                    continue
                size = np.concatenate([[0], np.cumsum(part.column(2).flatten().to_numpy(), dtype=np.int64)])
                h = tk.mix64(part.column(1).flatten().to_numpy().view(np.uint64) ^ tk._GRAM_MULT)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * tk.powers(tk._MULT, n), dtype=np.uint64)])
                doc = np.repeat(np.arange(len(lines)), lines)
                end = np.cumsum(lines)
                at = np.arange(n)
                stop = np.searchsorted(size, size[:-1] + least_block)
                start = np.searchsorted(size, size[1:] - least_block, side="right") - 1
                ahead = stop <= end[doc]
                # a run that is minimal both ways counts once
                back = start >= (end - lines)[doc]
                back[back] = stop[start[back]] != at[back] + 1
                a, b = np.concatenate([at[ahead], start[back]]), np.concatenate([stop[ahead], at[back] + 1])
                key = tk.mix64((sums[b] - sums[a]) * tk.powers(inverse, n)[a] ^ (b - a).astype(np.uint64))
                d = np.concatenate([doc[ahead], doc[back]])
                head = (end - lines)[d]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column(0).take(pa.array(d)), pa.array((a - head).astype(np.int32)), pa.array((b - head).astype(np.int32))], ["key", "id", "start", "stop"])

    return run


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, starts, stops) -> (id, mask): a byte a line up to the last one to delete, 1 where it goes."""
    for batch in batches:
        out = []
        for starts, stops in zip(batch.column(1), batch.column(2)):
            a, b = starts.values.to_numpy(), stops.values.to_numpy()
            depth = np.zeros(int(b.max()) + 1, np.int64)
            np.add.at(depth, a, 1)
            np.add.at(depth, b, -1)
            out.append((np.cumsum(depth)[:-1] > 0).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "mask"])


def deleted_lines(docs: DataFrame, key: str = "doc_id", text_col: str = "text", rare: int = RARE, least_block: int = LEAST_BLOCK) -> DataFrame:
    """(id, mask): for each text that has any lines to delete, a byte a line, 1 for those (later lines stay).
    key: an unrepeated long a row; rows where it is null are left out."""
    seq = docs.select(F.col(f"`{key}`").alias("id"), text_of(text_col).alias("text")).where("id IS NOT NULL AND text <> ''").mapInArrow(line_sequences, "id long, hashes array<long>, sizes array<int>")
    seq = checkpointed(seq)
    runs = seq.mapInArrow(run_rows(least_block), "key long, id long, start int, stop int")
    # written, so that a key in a third of the documents is split as a skewed side of the join
    lead = checkpointed(runs.groupBy("key").agg(F.min("id").alias("lead"), F.count("*").alias("n")).where("n > 1"))
    hits = checkpointed(runs.join(lead.hint("merge"), "key").where("id <> lead").select("id", "start", "stop", "lead", "n"))
    pairs = hits.where(F.col("n") <= rare).select("id", F.col("lead").alias("earlier")).distinct()
    one = seq.select("id", F.col("hashes").alias("a"), F.col("sizes").alias("s"))
    two = seq.select(F.col("id").alias("earlier"), F.col("hashes").alias("b"))
    aligned = pairs.join(one, "id").join(two, "earlier").select("id", "a", "s", "b").mapInArrow(_align(least_block), "id long, start int, stop int")
    cut = hits.select("id", "start", "stop").unionByName(aligned).groupBy("id").agg(F.collect_set(F.struct("start", "stop")).alias("cut"))
    return cut.select("id", "cut.start", "cut.stop").mapInArrow(_masks, "id long, mask binary")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs, its columns kept, without the blocks of consecutive lines, of at least LEAST_BLOCK bytes together, that
    an earlier document has too; n_chars, if there is such a column, follows the text.

    Earlier is by id; ids may be of any type.  Rows that share an id are documents of their own, ordered by their
    content (ties: equal rows, of which one stays first).  A document of which only blank lines would be left goes,
    so of equal texts the first stays.  Blanks at the ends of lines don't count; equal lines of one text are no
    overlap.  Rows without an id, null, empty and blank texts stay as they are.  Texts are read whole; the work
    is linear in their lines, but for patience diff's gaps.  An empty table stays empty; other columns may have any name.
    """
    k = row_keys(docs, id_col)
    key, mask = fresh(k.docs, "tm_id", "tm_mask")
    found = deleted_lines(k.docs, k.key, text_col, **options).toDF(key, mask)
    joined = k.docs.join(found.hint("shuffle_hash"), F.col(f"`{k.key}`") == F.col(key), "left")
    text = F.col(f"`{text_col}`").cast("string")
    # one byte of the mask a line: no search, so rewriting is linear in the lines
    gone = lambda i: F.coalesce(F.substring(F.col(mask), i + 1, F.lit(1)) == F.lit(b"\x01"), F.lit(False))
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~gone(i)), "\n")
    new = F.when(F.col(mask).isNull(), text).otherwise(left)
    kept = joined.withColumn(text_col, new).where(F.col(mask).isNull() | F.col(f"`{text_col}`").rlike(r"[^\x00-\x20\x7f]"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col(mask).isNull(), F.col("n_chars")).otherwise(F.char_length(text_col).cast(dict(docs.dtypes)["n_chars"])))
    return kept.select(*[f"`{c}`" for c in docs.columns])


#: Step 4 covers what step 3 finds, so the runs alone give the result.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^[\x00-\x20\x7f]+|[\x00-\x20\x7f]+$', '', 'g')) AS ls FROM documents WHERE text <> ''),
i AS (SELECT doc_id, ls, unnest(range(len(ls))) AS i FROM d),
c AS (SELECT doc_id, i, ls, sum(strlen(ls[i + 1])) OVER (PARTITION BY doc_id ORDER BY i) AS upto, strlen(ls[i + 1]) AS own FROM i),
f AS (SELECT a.doc_id, a.i AS start, b.i + 1 AS stop, a.ls FROM (SELECT *, upto - own + 50 AS need FROM c) a ASOF JOIN (SELECT doc_id, upto, min(i) AS i FROM c GROUP BY ALL) b ON a.doc_id = b.doc_id AND a.need <= b.upto),
e AS (SELECT a.doc_id, b.i AS start, a.i + 1 AS stop, a.ls FROM (SELECT *, upto - 50 AS need FROM c) a ASOF JOIN (SELECT doc_id, upto - own AS before, max(i) AS i FROM c GROUP BY ALL) b ON a.doc_id = b.doc_id AND a.need >= b.before),
r AS (SELECT doc_id, start, stop, md5(array_to_string(ls[start + 1 : stop], chr(10)) || chr(10) || (stop - start)) AS k FROM (SELECT DISTINCT doc_id, start, stop, ls FROM (SELECT * FROM f UNION ALL SELECT * FROM e)) WHERE stop > start),
h AS (SELECT doc_id, start, stop FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS lead FROM r) WHERE lead < doc_id),
g AS (SELECT doc_id, list(DISTINCT n) AS gone FROM (SELECT doc_id, unnest(range(start, stop)) AS n FROM h) GROUP BY doc_id),
t AS (SELECT o.doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, n: NOT list_contains(gone, n - 1)), chr(10)) END AS text, lang, source, n_chars, gone FROM documents o LEFT JOIN g USING (doc_id))
SELECT doc_id, text, lang, source, CASE WHEN gone IS NULL THEN n_chars ELSE length(text) END AS n_chars FROM t WHERE gone IS NULL OR regexp_matches(text, '[^\x00-\x20\x7f]')
"""
