import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WIDE = DOCS + ", id long, band string, rank string, tm_id string, tm_cut string, tm_position string, tm_gone string, tm_toxic string, label int, tokens int"


def words(n, seed, size=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))


def docs(spark, rows, wide=False):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *([None, None][len(r) - 2 :] if len(r) < 4 else []))[:4] for r in rows]
    full = [(*r, len(r[1]) if r[1] is not None else None) for r in full]
    if wide:
        full = [(*r, 1, "x", "y", "a", "b", "c", "d", "e", 5, 6) for r in full]
    return spark.createDataFrame(full, WIDE if wide else DOCS)


def awkward(seed=0):
    """Nulls in every column, empty, blank, word-free and very long texts, repeated rows and ids."""
    long = words(30_000, seed)
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, "  \n\n ", "en", "a"),
        (4, "... !!! ---", None, "a"),
        (5, words(120, 5), "en", None),
        (6, long, "en", "b"),
        (7, long, "en", "b"),
        (8, "x" * 50_000, "en", "b"),
        (9, "one", "de", "b"),
        (9, "one", "de", "b"),
        (10, words(100, 10), "de", "c"),
        (10, words(100, 11), "de", "c"),
        (None, words(80, 12), "en", "a"),
        (None, words(80, 12), "en", "a"),
    ]


def rows(df):
    return [tuple(r) for r in df.collect()]
