"""Repeated passages by distributed prefix doubling over word positions.

The order of the suffixes up to a threshold of L words decides which positions start a passage of
L words that occurs elsewhere.  A position's rank at h words is the first position, by (document,
place), with the same h words.  One round doubles h, the last one stops at L: position i pairs its
own rank with that of i + (new h - h), Spark sorts the pairs with their positions, and equal
neighbours get a new rank; positions that are alone are unique and leave.

* Before the rounds, words become hashes and runs of the first h (16 for L = 50) words get their
  names inside each text, in numpy.  Round zero sorts sampled (name, position) pairs only: in each
  run of L words the least name is an anchor; equal passages have equal anchors, so a position whose
  anchor is unique in the corpus is unique at L and leaves.  The sample follows content and loses
  nothing.  A text whose words are those of an earlier one is found by a hash of them all; all its
  positions are known then, and it is one row in the rounds.
* The first full round sorts pairs of names, all later ones pairs of ranks.
* Where the two ranks of a pair are themselves that far apart in one document, the pair's first
  position is known without a sort: it is the first of the two ranks, and no other pair is equal to
  it.  So rounds after the first sort only the positions near the ends of repeats.

Each round is one shuffle by rank pairs and one back to the documents, of rows of fixed width;
nothing is collected or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit as tk
from tidemark.llm.common import fresh, row_keys, text_of

LENGTH = 50
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
RANKS = "id long, pos int, first_id long, first_pos int"
PAIR_NAMES = ["a_id", "a_pos", "b_id", "b_pos", "id", "pos", "stop", "first_id", "first_pos"]
PAIRS = "a_id long, a_pos int, b_id long, b_pos int, id long, pos int, stop int, first_id long, first_pos int"


def rounds(length: int) -> list[int]:
    """Words that ranks stand for: the names' number, then after each round, `length` last."""
    out = [1 << max(0, (length // 3).bit_length() - 1)]
    while True:
        out.append(min(2 * out[-1], length))
        if out[-1] == length:
            return out


def _anchors(texts: pa.Array, length: int) -> tuple[tk.Words, np.ndarray, np.ndarray]:
    """(words, name of each position, least name of each run of `length` words)."""
    w = tk.words_of(texts)
    first = rounds(length)[0]
    g = np.minimum(tk.grams(w.hash, first), TOP - np.uint64(1))
    span = length - first + 1
    least = tk.sliding(np.minimum, g, span) if len(g) >= span else np.zeros(0, np.uint64)
    return w, g, least


def _copies(w: tk.Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, second hash) of the whole word sequence of each text that has `length` words."""
    n = np.diff(w.first)
    doc = np.flatnonzero(n >= length)
    if not len(doc):
        return doc, np.zeros(0, np.uint64), np.zeros(0, np.int32)
    at = np.arange(len(w.hash)) - w.first[w.doc]
    keep = n[w.doc] >= length
    head = np.cumsum(n[doc]) - n[doc]
    one, two = (tk.mix64(np.add.reduceat((w.hash * tk.powers(m, int(n.max()))[at])[keep], head) ^ n[doc].astype(np.uint64)) for m in (tk._MULT, tk._GRAM_MULT))
    return doc, one, (two >> np.uint64(33)).astype(np.int32) | 1


def anchor_rows(length: int):
    """(rank, more, id, pos): anchors, whose `more` is 0, and one row a text for its whole sequence, with its words
    counted below 0 in pos."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = length - rounds(length)[0] + 1
        for batch in batches:
            ids = batch.column(0)
            for at, texts in tk.chunked(batch.column(1)):
                w, g, least = _anchors(texts, length)
                ok = tk.within(w.first, length)
                if not ok.any():
                    continue
                # an anchor is the least of some run that holds it: the largest least of those runs equals it
                padded = np.zeros(len(g) + span - 1, np.uint64)
                padded[span - 1 : span - 1 + len(least)] = np.where(ok, least, np.uint64(0))
                at_word = np.flatnonzero(tk.sliding(np.maximum, padded, span) == g)
                doc, one, two = _copies(w, length)
                rank = np.concatenate([g[at_word], one]).view(np.int64)
                more = np.concatenate([np.zeros(len(at_word), np.int32), two])
                owner = np.concatenate([w.doc[at_word], doc])
                pos = np.concatenate([at_word - w.first[w.doc[at_word]], -np.diff(w.first)[doc]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(rank), pa.array(more), ids.take(pa.array(at + owner)), pa.array(pos)], ["rank", "more", "id", "pos"])

    return run


def _with_end(batches):
    yield from batches
    yield None


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple]:
    """Sorted rows in chunks, each with: has it an equal on the keys, and the first of these's (id, pos).  Tuples pass."""
    held, before, lead = None, None, (0, 0)
    for batch in _with_end(batches):
        if isinstance(batch, tuple):
            yield batch
            continue
        rows = held if batch is None else pa.Table.from_batches([batch])
        if batch is not None and held is not None:
            rows = pa.concat_tables([held, rows])
        if rows is None or not rows.num_rows:
            continue
        rows = rows.combine_chunks()
        cols = [rows.column(k).to_numpy() for k in keys]
        same = np.ones(len(cols[0]) - 1, bool)
        for c in cols:
            same &= c[1:] == c[:-1]
        prior = np.concatenate([[before is not None and all(c[0] == b for c, b in zip(cols, before))], same])
        after = np.concatenate([same, [False]])
        n = len(prior) if batch is None else len(prior) - 1
        if n:
            ids, pos = rows.column("id").to_numpy(), rows.column("pos").to_numpy()
            head = np.maximum.accumulate(np.where(prior, -1, np.arange(len(prior))))
            first_id, first_pos = np.where(head < 0, lead[0], ids[head]), np.where(head < 0, lead[1], pos[head])
            yield rows.slice(0, n), (prior | after)[:n], first_id[:n], first_pos[:n]
            before, lead = [c[n - 1] for c in cols], (first_id[n - 1], first_pos[n - 1])
        held = None if batch is None else rows.slice(n)


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (rank, more, id, pos) -> the anchors that another place has (copy_of null), and the texts whose
    words are those of an earlier one."""
    for rows, hit, first_id, _ in _grouped(batches, ["rank", "more"]):
        ids, pos = (rows.column(c).to_numpy() for c in ("id", "pos"))
        copy = pos < 0
        keep = hit & (~copy | (ids != first_id))
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(pos[keep]), pa.array(first_id[keep], mask=~copy[keep])], ["id", "pos", "copy_of"])


def pair_rows(length: int):
    """(id, text, positions of repeated anchors, copy_of) -> name pairs of every position that a later round needs.
    A text that is a copy has one row, with its words counted below 0 in pos."""
    steps = rounds(length)
    reach = {0}
    for h, wide in zip(steps[1:], steps[2:]):
        reach |= {x + wide - h for x in reach}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = length - steps[0] + 1
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            copies = batch.filter(batch.column(3).is_valid())
            if n := copies.num_rows:
                pos = np.fromiter((a[0].as_py() for a in copies.column(2)), np.int32, n)
                name = tk.mix64(copies.column(0).to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(pos), copies.column(0), pa.array(pos), copies.column(3)], ["r1", "r2", "id", "pos", "copy_of"])
            batch = batch.filter(batch.column(3).is_null())
            ids, anchors = batch.column(0), batch.column(2)
            for at, texts in tk.chunked(batch.column(1)):
                w, g, least = _anchors(texts, length)
                mine = anchors.slice(at, len(texts))
                where = mine.flatten().to_numpy() + np.repeat(w.first[:-1], mine.value_lengths().to_numpy())
                live = np.full(len(g), TOP)
                live[where] = g[where]
                left = np.flatnonzero((tk.sliding(np.minimum, live, span) == least) & tk.within(w.first, length)) if len(least) else []
                need = np.zeros(len(g), bool)
                for x in reach:
                    need[np.asarray(left, np.int64) + x] = True
                left = np.flatnonzero(need)
                for lo in range(0, len(left), 1 << 16):
                    i = left[lo : lo + (1 << 16)]
                    other = (g[i + steps[1] - steps[0]] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(g[i].view(np.int64)), pa.array(other), ids.take(pa.array(at + w.doc[i])), pa.array((i - w.first[w.doc[i]]).astype(np.int32)), pa.nulls(len(i), pa.int64())], ["r1", "r2", "id", "pos", "copy_of"])

    return run


def first_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (r1, r2, id, pos) -> ranks of those that aren't alone, and the copies."""

    def names():
        for batch in batches:
            copy = batch.column("copy_of").is_valid()
            if (known := batch.filter(copy)).num_rows:
                yield (pa.RecordBatch.from_arrays([known.column("id"), known.column("pos"), known.column("copy_of"), pa.array(np.zeros(known.num_rows, np.int32))], ["id", "pos", "first_id", "first_pos"]),)
            yield batch.filter(pc.invert(copy)).select(["r1", "r2", "id", "pos"])

    for rows, *found in _grouped(names(), ["r1", "r2"]):
        if not found:
            yield rows
            continue
        hit, first_id, first_pos = found
        if hit.any():
            ids, pos = (rows.column(c).to_numpy()[hit] for c in ("id", "pos"))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(pos), pa.array(first_id[hit]), pa.array(first_pos[hit].astype(np.int32))], ["id", "pos", "first_id", "first_pos"])


def paired(offset: int, length: int, last: bool):
    """Ranks sorted by (id, pos) -> pairs of ranks `offset` apart.  Pairs whose first position is known have no
    a and b but that first position; in the last round they come as runs [pos, stop) that move in step, and copies as
    the run of all their starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            if batch is not None and not batch.num_rows:
                continue
            now = [c.to_numpy() for c in batch.columns] if batch is not None else [np.zeros(0, np.int64)] * 4
            now = [np.concatenate([r, c]) for r, c in zip(rest, now)] if rest is not None else now
            n = len(now[0]) if batch is None else int(np.searchsorted(now[0], now[0][-1]))
            rest = [c[n:] for c in now]
            ids, pos, fid, fpos = (c[:n].astype(np.int64) for c in now)
            copy = np.flatnonzero(pos < 0)
            if len(copy):
                none, zero = [pa.nulls(len(copy), t) for t in (pa.int64(), pa.int32())] * 2, np.zeros(len(copy), np.int32)
                start, stop = (zero, 1 - length - pos[copy]) if last else (pos[copy], pos[copy])
                yield pa.RecordBatch.from_arrays([*none, pa.array(ids[copy]), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(fid[copy]), pa.array(zero)], PAIR_NAMES)
                ids, pos, fid, fpos = (c[pos >= 0] for c in (ids, pos, fid, fpos))
                n = len(ids)
            if not n:
                continue
            doc = np.cumsum(np.concatenate([[0], ids[1:] != ids[:-1]]))
            place = (doc << 32) + pos
            j = np.minimum(np.searchsorted(place, place + offset), n - 1)
            i = np.flatnonzero(place[j] == place + offset)
            j = j[i]
            known = (fid[i] == fid[j]) & (fpos[j] == fpos[i] + offset)
            far, near = i[~known], i[known]
            to = j[~known]
            stop = pos[near] + 1
            if last:
                later = (fid[near] != ids[near]) | (fpos[near] != pos[near])
                near = near[later]
                new = np.ones(len(near), bool)
                new[1:] = (place[near][1:] != place[near][:-1] + 1) | (fid[near][1:] != fid[near][:-1]) | (fpos[near][1:] != fpos[near][:-1] + 1)
                head = np.flatnonzero(new)
                stop = pos[near][np.append(head[1:], len(near)) - 1] + 1 if len(near) else pos[near]
                near = near[head]
            for rows, pair in ((far, True), (near, False)):
                end = pos[rows] + 1 if pair else stop
                for lo in range(0, len(rows), 1 << 16):
                    k, t = rows[lo : lo + (1 << 16)], to[lo : lo + (1 << 16)]
                    none = pa.nulls(len(k), pa.int64()), pa.nulls(len(k), pa.int32())
                    a = (pa.array(fid[k]), pa.array(fpos[k].astype(np.int32)), pa.array(fid[t]), pa.array(fpos[t].astype(np.int32))) if pair else none * 2
                    f = none if pair else (pa.array(fid[k]), pa.array(fpos[k].astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*a, pa.array(ids[k]), pa.array(pos[k].astype(np.int32)), pa.array(end[lo : lo + (1 << 16)].astype(np.int32)), *f], PAIR_NAMES)

    return run


def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs sorted by (a, b, id, pos) -> (id, pos, stop, first): known ones as they are, of the others those that aren't alone."""

    names = ["id", "pos", "stop", "first_id", "first_pos"]

    def pairs():
        for batch in batches:
            unknown = batch.column("a_id").is_valid()
            if (known := batch.filter(pc.invert(unknown))).num_rows:
                yield (known.select(names),)
            yield batch.filter(unknown)

    for rows, *found in _grouped(pairs(), ["a_id", "a_pos", "b_id", "b_pos"]):
        if not found:
            yield rows
            continue
        hit, first_id, first_pos = found
        if hit.any():
            kept = rows.filter(pa.array(hit)).combine_chunks()
            yield pa.RecordBatch.from_arrays([*(kept.column(c).combine_chunks() for c in names[:3]), pa.array(first_id[hit]), pa.array(first_pos[hit].astype(np.int32))], names)


def _merged(ids: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge sorted intervals that touch: (id, start, stop)."""
    if not len(ids):
        return ids, start, stop
    doc = np.cumsum(np.concatenate([[0], ids[1:] != ids[:-1]])) << 32
    reach = np.maximum.accumulate(doc + stop)
    new = np.concatenate([[True], (doc + start)[1:] > reach[:-1]])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(ids)) - 1
    return ids[head], start[head], reach[tail] - doc[tail]


def span_rows(length: int):
    """Runs of starting positions sorted by (id, start, stop) -> spans of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            if batch is not None and not batch.num_rows:
                continue
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns] if batch is not None else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
            now = [np.concatenate([r, c]) for r, c in zip(rest, now)] if rest is not None else now
            n = len(now[0]) if batch is None else int(np.searchsorted(now[0], now[0][-1]))
            rest = [c[n:] for c in now]
            ids, start, stop, later = (c[:n] for c in now)
            if not n:
                continue
            start, stop = start.astype(np.int64), stop.astype(np.int64) - 1 + length
            doc, a, b = _merged(ids, start, stop)
            count = np.zeros(len(doc), np.int64)
            d, s, e = _merged(ids[later], start[later], stop[later])
            owner = np.searchsorted(np.rec.fromarrays([doc, a]), np.rec.fromarrays([d, s]), side="right") - 1
            np.add.at(count, owner, e - s)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(count.astype(np.int32))], ["doc_id", "start_word", "end_word", "later_words"])

    return run


def _repeats(docs: DataFrame, length: int, key: str, text_col: str, wide: bool = False) -> DataFrame:
    """(id, pos, stop, first_id, first_pos): the starts [pos, stop) of runs of `length` words that equal those from
    the first one on; first ones aren't rows.  wide: the texts are joined with all their columns and rows, so that a
    later left join of docs on the key reuses that shuffle."""
    if length < 1:
        raise ValueError("length must be positive")
    steps = rounds(length)
    read = docs.select(F.col(f"`{key}`").alias("id"), text_of(text_col).alias("text")).where("id IS NOT NULL")
    first = read.mapInArrow(anchor_rows(length), "rank long, more int, id long, pos int")
    live = first.repartition("rank").sortWithinPartitions("rank", "more", "id", "pos").mapInArrow(repeated, "id long, pos int, copy_of long")
    live = live.groupBy("id").agg(F.sort_array(F.collect_list("pos")).alias("anchors"), F.min("copy_of").alias("copy_of"))
    if wide:
        name, anchors, copy, mine, body = fresh(docs, "tm_id", "tm_anchors", "tm_copy", "tm_mine", "tm_body")
        left = docs.join(live.toDF(name, anchors, copy).hint("shuffle_hash"), F.col(f"`{key}`") == F.col(name), "left")
        left = left.select(F.col(f"`{key}`").alias(mine), text_of(text_col).alias(body), anchors, copy, *[f"`{c}`" for c in docs.columns])
    else:
        left = read.join(live.hint("shuffle_hash"), "id").select("id", "text", "anchors", "copy_of")
    pairs = left.mapInArrow(pair_rows(length), "r1 long, r2 int, id long, pos int, copy_of long")
    ranks = pairs.repartition("r1", "r2").sortWithinPartitions("r1", "r2", "id", "pos").mapInArrow(first_ranks, RANKS)
    # where there is one round only, its ranks are the runs, and copies all their starts
    copy = F.col("pos") < 0
    done = ranks.select("id", F.when(copy & F.lit(len(steps) == 2), 0).otherwise(F.col("pos")).alias("pos"), F.when(copy, 1 - length - F.col("pos")).otherwise(F.col("pos") + 1).alias("stop"), "first_id", "first_pos")
    for h, wider in zip(steps[1:], steps[2:]):
        rows = done.select("id", "pos", "first_id", "first_pos").repartition("id").sortWithinPartitions("id", "pos").mapInArrow(paired(wider - h, length, wider == length), PAIRS)
        # known pairs pass the sort by: they are spread by their own place
        where = F.when(F.col("a_id").isNull(), F.xxhash64("id", "pos")).otherwise(F.xxhash64("a_id", "a_pos", "b_id", "b_pos"))
        rows = rows.repartition(where).sortWithinPartitions("a_id", "a_pos", "b_id", "b_pos", "id", "pos")
        done = rows.mapInArrow(ranked, "id long, pos int, stop int, first_id long, first_pos int")
    return done.where("id <> first_id OR pos <> first_pos")


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, later_words): the maximal spans, by word number and end exclusive,
    of words that lie in a run of `length` words occurring at least twice in the corpus, in one text or
    several.  later_words counts those in a run that also occurs earlier, by (doc_id, position).

    Null, empty and shorter texts and rows without an id have no span.  Ids may be of any type; rows that share one
    are texts of their own, in the order of their content, and each has its spans.  Texts are read whole, however
    long; ties don't occur.  An empty table gives an empty result; other columns aren't read.
    """
    k = row_keys(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), id_col)
    hits = _repeats(k.docs, length, k.key, text_col)
    # a run and the place that it repeats; many repeat the same place, which is sent once a task
    both = F.array(F.struct("id", F.col("pos").alias("start"), "stop", F.lit(True).alias("later")), F.struct(F.col("first_id").alias("id"), F.col("first_pos").alias("start"), (F.col("first_pos") + F.col("stop") - F.col("pos")).alias("stop"), F.lit(False).alias("later")))
    runs = hits.select(F.explode(both).alias("r")).select("r.*").distinct()
    spans = runs.repartition("id").sortWithinPartitions("id", "start", "stop").mapInArrow(span_rows(length), "doc_id long, start_word int, end_word int, later_words int")
    return k.named(spans, "doc_id")


def _cut(length: int):
    @F.arrow_udf("string")
    def run(texts: pa.Array, later: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, later):
            text = text.as_py()
            if found.is_valid:
                # lower-casing can change byte lengths, so words are found in the text as it is
                w = tk.words_of(pa.array([text]), lower=False)
                raw, parts, at = w.data.tobytes(), [], 0
                start, stop = (found.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                _, s, e = _merged(np.zeros(len(start), int), start, stop - 1 + length)
                for a, b in zip(s, e):
                    parts.append(raw[at : w.start[a]])
                    at = w.end[b - 1]
                text = b"".join([*parts, raw[at:]]).decode("utf-8", "replace")
            out.append(text)
        return pa.array(out, pa.string())

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, its columns kept, without the words that `repeated_spans` counts as later.

    Every row stays, one of which no word is left as well; rows that share an id are texts of their own.  Null and
    empty texts, rows without an id and texts without repeats stay as they are.  n_chars, if there is such a column,
    follows the text.  An empty table stays empty; other columns may have any name.
    """
    k = row_keys(docs, id_col)
    name, found = fresh(k.docs, "tm_id", "tm_found")
    later = _repeats(k.docs, length, k.key, text_col, wide=True).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "stop"))).alias("found"))
    joined = k.docs.join(later.toDF(name, found).hint("shuffle_hash"), F.col(f"`{k.key}`") == F.col(name), "left")
    text, kept = F.col(f"`{text_col}`"), F.col(found).isNull()
    out = joined.withColumn(text_col, F.when(kept, text).otherwise(_cut(length)(text.cast("string"), F.col(found))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(kept, F.col("n_chars")).otherwise(F.char_length(text).cast(dict(docs.dtypes)["n_chars"])))
    return out.select(*[f"`{c}`" for c in docs.columns])


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(0, len(ws) - 49)) AS pos FROM w WHERE len(ws) >= 50),
g AS (SELECT doc_id, pos, md5(array_to_string(ws[pos + 1 : pos + 50], ' ')) AS g FROM i),
r AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY g) AS n, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS k FROM g),
a AS (SELECT doc_id, pos, k > 1 AS later, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50, true) AS new FROM r WHERE n > 1),
s AS (SELECT doc_id, pos, later, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM a),
spans AS (SELECT doc_id, span, min(pos)::INT AS start_word, (max(pos) + 50)::INT AS end_word FROM s GROUP BY ALL),
l AS (SELECT doc_id, span, pos, least(50, coalesce(lead(pos) OVER (PARTITION BY doc_id, span ORDER BY pos) - pos, 50)) AS words FROM s WHERE later)
SELECT doc_id, start_word, end_word, coalesce((SELECT sum(words) FROM l WHERE l.doc_id = spans.doc_id AND l.span = spans.span), 0)::INT AS later_words FROM spans
"""
