"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch.  A sketch has t bins.  In round i < t every shingle of a document goes to one
hashed bin with a hashed value; only bins that are still empty take the least value that
reaches them.  Round t + j sends every shingle to bin j.  So every bin is full after 2t
rounds at the latest, with the concentration of independent samples, and a document of
n >> t log t shingles needs one or two rounds instead of t passes (Dahlgaard, Knudsen and
Thorup, "Fast Similarity Sketching", 2017).

Banding.  Documents whose `rows` bins of a band agree share a bucket.  Texts with equal
shingle sets are first folded to the least doc_id, so copies in thousands cost one row.
Each bucket's members are verified against its least member, so a bucket of n near copies
costs n - 1 comparisons.  Where a bucket's members are still in different groups, no bucket
is multiplied with itself: similar sets share one of their rarest shingles (prefix filter,
which loses no pair), so only documents that share such a shingle are compared.  The groups
are those that all pairs of all buckets would give.

Verification is exact: Jaccard similarity of the whole texts' shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit as tk
from tidemark.llm.common import checkpointed, components, fresh, row_keys, sized, text_of

SHINGLE, THRESHOLD, BANDS, ROWS = 3, 0.6, 32, 5
U64 = np.uint64


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle) without repeats, in order; a text of fewer words than a shingle is one shingle."""
    w = tk.words_of(texts)
    n = np.diff(w.first)
    g = tk.grams(w.hash, size)
    ok = tk.within(w.first, size)
    doc, h = w.doc[: len(g)][ok], g[ok]
    for d in np.flatnonzero((n > 0) & (n < size)):
        h = np.append(h, tk.grams(w.hash[w.first[d] : w.first[d + 1]], int(n[d])))
        doc = np.append(doc, d)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def sketch(doc: np.ndarray, h: np.ndarray, n_docs: int, t: int) -> np.ndarray:
    """n_docs x t bins; rows of documents without shingles stay at the largest value."""
    empty = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n_docs * t, empty, U64)
    for i in range(2 * t):
        if not len(doc):
            break
        v = tk.mix64(h ^ tk.mix64(np.array([i + 1], U64)))
        bins = ((v >> U64(40)) % U64(t)).astype(np.int64) if i < t else np.full(len(h), i - t)
        at = doc * t + bins
        now = np.full(n_docs * t, empty, U64) if i == 0 else None
        v = np.minimum(tk.mix64(v), empty - U64(1))
        if now is not None:
            np.minimum.at(now, at, v)
            out = now
        else:
            free = out[at] == empty
            np.minimum.at(out, at[free], v[free])
        unfilled = (out.reshape(n_docs, t) == empty).any(1)
        keep = unfilled[doc]
        if not keep.all():
            doc, h = doc[keep], h[keep]
    return out.reshape(n_docs, t)


def signatures(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, texts in tk.chunked(batch.column(1)):
                doc, h = shingle_sets(texts, size)
                n = np.bincount(doc, minlength=len(texts))
                some = np.flatnonzero(n)
                if not len(some):
                    continue
                a, b = (np.add.reduceat(tk.mix64(h ^ U64(x)), np.cumsum(n[some]) - n[some]) for x in (17, 71))
                number = np.full(len(texts), -1)
                number[some] = np.arange(len(some))
                s = sketch(number[doc], h, len(some), bands * rows).reshape(len(some), bands, rows)
                key = tk.mix64(np.arange(bands, dtype=U64) + U64(1))[None, :].repeat(len(some), 0)
                for r in range(rows):
                    key = tk.mix64(key + s[:, :, r])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at + some)),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                        pa.FixedSizeListArray.from_arrays(pa.array(key.reshape(-1).view(np.int64)), bands).cast(pa.list_(pa.int64())),
                    ],
                    ["id", "k1", "k2", "bands"],
                )

    return run


def jaccard(size: int, threshold: float):
    """Rows (u, v, text of u, text of v) -> (u, v, similarity) at or above the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = tk.as_array(batch.column(2)), tk.as_array(batch.column(3))
            u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep, value = [], []
            for at, part in tk.chunked(left):
                a, b = (shingle_sets(x, size) for x in (part, right.slice(at, len(part))))
                ca, cb = (np.searchsorted(x[0], np.arange(len(part) + 1)) for x in (a, b))
                for k in range(len(part)):
                    x, y = a[1][ca[k] : ca[k + 1]], b[1][cb[k] : cb[k + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    s = both / max(1, len(x) + len(y) - both)
                    if s >= threshold:
                        keep.append(at + k)
                        value.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep]), pa.array(np.array(value, float))], ["u", "v", "similarity"])

    return run


def shingle_rows(size: int):
    """(id, label, text) -> (id, label, n, shingle): each of the n shingles of a text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in tk.chunked(batch.column(2)):
                doc, h = shingle_sets(texts, size)
                n = np.bincount(doc, minlength=len(texts)).astype(np.int32)
                rows = pa.array(at + doc)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(n[doc]), pa.array(h.view(np.int64))], ["id", "label", "n", "shingle"])

    return run


def prefix_pairs(texts: DataFrame, labels: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(u, v), u > v: candidates among the labelled documents (id, label) with different labels; all pairs whose
    similarity is at least `threshold` are among them.

    Two sets of which the larger has n elements share threshold * n of them at least, so if all sets are ordered the
    same way, each has a shared element among its first n - ceil(threshold * n) + 1.  The order is from the rarest
    shingle on; shingles of one document only take places there but pair nothing, so they aren't shuffled on."""
    rows = texts.join(labels.hint("shuffle_hash"), "id").select("id", "label", "text").mapInArrow(shingle_rows(shingle), "id long, label long, n int, shingle long")
    shared = checkpointed(rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"))
    mine = rows.join(shared.hint("merge"), "shingle").groupBy("id", "label", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("common"))
    reach = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1 - (F.col("n") - F.size("common"))
    first = mine.where(reach > 0).select("id", "label", F.explode(F.slice("common", F.lit(1), reach.cast("int"))).alias("s")).select("id", "label", F.col("s.shingle").alias("shingle"))
    first = checkpointed(first)
    pairs = first.alias("x").join(first.alias("y"), F.expr("x.shingle = y.shingle AND x.label <> y.label AND x.id > y.id"))
    return pairs.select(F.col("x.id").alias("u"), F.col("y.id").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, duplicate_of) for every document of a group but its least doc_id, which is duplicate_of.

    A group is a connected set of pairs whose shingle sets have a Jaccard similarity of at least
    `threshold`.  Null and word-free texts and rows without an id are in no group.  Texts shorter than a
    shingle are one shingle; longer ones are read whole, however long.  Ids may be of any type; rows that share
    one are documents of their own, so that a row can be a duplicate of another of its id.  Ties don't occur.
    An empty table gives an empty result; other columns aren't read.
    """
    k = row_keys(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), id_col)
    return k.named(_near(k.docs, k.key, text_col, shingle, threshold, bands, rows), "doc_id", "duplicate_of")


def _near(docs: DataFrame, key: str, text_col: str, shingle: int, threshold: float, bands: int, rows: int) -> DataFrame:
    read = docs.select(F.col(f"`{key}`").alias("id"), text_of(text_col).alias("text")).where("id IS NOT NULL")
    found = checkpointed(read.mapInArrow(signatures(shingle, bands, rows), "id long, k1 long, k2 long, bands array<long>"))
    # groups are counted with partial aggregation and written, then joined, so that a group or a bucket with a third
    # of the rows is split as a skewed side and no window holds it
    rep = checkpointed(found.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n"))
    copies = checkpointed(found.drop("bands").join(rep.hint("merge"), ["k1", "k2"]).where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v")))
    one = found.select("id", "bands").join(copies.select(F.col("u").alias("id")), "id", "left_anti")

    member = one.select("id", F.explode("bands").alias("band"))
    lead = checkpointed(member.groupBy("band").agg(F.min("id").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n"))
    member = checkpointed(member.join(lead.hint("merge"), "band").select("id", "band", "lead"))
    texts = read.join(sized(member.select("id").distinct()), "id", "left_semi")

    def verified(pairs: DataFrame) -> DataFrame:
        one = texts.select(F.col("id").alias("u"), F.col("text").alias("a"))
        two = texts.select(F.col("id").alias("v"), F.col("text").alias("b"))
        return checkpointed(pairs.join(one.hint("shuffle_hash"), "u").join(two.hint("shuffle_hash"), "v").select("u", "v", "a", "b").mapInArrow(jaccard(shingle, threshold), "u long, v long, similarity double"))

    tried = member.where("id <> lead").select(F.col("id").alias("u"), F.col("lead").alias("v")).distinct()
    edges = verified(tried).select("u", "v")
    label = components(edges)
    group = member.select("id", "band").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = group.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("band")
    group = group.join(mixed, "band", "left_semi")
    left = checkpointed(group.select("id", "label").distinct())
    more = checkpointed(prefix_pairs(texts, left, shingle, threshold).join(tried, ["u", "v"], "left_anti"))
    if not more.isEmpty():
        edges = edges.unionByName(verified(more).select("u", "v"))
        label = components(edges)
    # a copy belongs where the text that it repeats belongs
    label = label.select(F.col("id").alias("v"), "label")
    pairs = copies.join(label, "v", "left").select(F.col("u").alias("doc_id"), F.coalesce("label", "v").alias("duplicate_of"))
    return pairs.unionByName(label.select(F.col("v").alias("doc_id"), F.col("label").alias("duplicate_of")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """docs, its columns kept, without the rows that near_duplicates() names: one of each group stays, the first by
    id and, of rows that share an id, by content.  Rows in no group (null and word-free texts, rows without an id)
    stay.  An empty table stays empty; other columns may have any name."""
    k = row_keys(docs, id_col)
    gone = checkpointed(_near(k.docs, k.key, text_col, shingle, threshold, bands, rows).select(F.col("doc_id").alias("tm_gone")))
    (name,) = fresh(k.docs, "tm_gone")
    return k.docs.join(sized(gone.withColumnRenamed("tm_gone", name)), F.col(f"`{k.key}`") == F.col(name), "left_anti").select(*[f"`{c}`" for c in docs.columns])
