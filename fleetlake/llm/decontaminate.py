"""Benchmark passages in training documents, found with spaced seeds; DataFrame functions only.

Texts become lower-cased runs of letters and digits.  A seed looks at six of
seven or ten neighbouring tokens and ignores the rest, so a substituted token
spoils only the seeds that look at it.  The two masks together hit every
stretch of 13 tokens with any two of them substituted.  An item of 7 to 12 tokens
is looked for with four masks of weight five, which hit it with any one (7 to 9
tokens) or two (10 to 12) substituted, and one of under seven with a single seed
of all its tokens.  Only the masks that the benchmark's items need are used.

1. the benchmark's seed hashes (a row per token and mask) are joined with the
   training side's.  They are broadcast while they hold at most
   ``broadcast_rows`` rows of about 40 bytes; beyond, the join shuffles by hash;
2. hits collapse to distinct (document, item, offset between the two), those of an
   item of under seven tokens to the first of a document;
3. each such alignment is verified on the tokens themselves: it counts when some
   ``window`` neighbouring tokens of the item agree with the document in at
   least ``ceil(0.8 * window)`` places (11 of 13; for a shorter item, of all
   its tokens; of one of under seven, all must agree).  Hash collisions end here.

The result has one row per contaminated (document, item), with its best alignment.
An item of one or two common words is found in very many documents; ``n_item`` tells.
Null and empty texts have no tokens; null ids are left out; rows that repeat an
id count once.  Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

# The looked-at positions of each mask.
MASKS = ((0, 1, 2, 3, 4, 6), (0, 2, 3, 7, 8, 9))
WINDOW = 13
#: for items of LEAST to WINDOW - 1 tokens; a shorter one must agree whole
SHORT_MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4), (0, 1, 3, 4, 5))
LEAST = 7


def tokens(column: str = "text"):
    return F.filter(F.split(F.lower(F.col(column)), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def seeds(texts: DataFrame, key: str, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """``texts(key, tokens)`` -> ``(key, at, seed)``: a hash of the looked-at tokens for every place and mask."""
    codes, n = list(masks), len(masks)
    shortest = min(m[-1] for m in masks.values()) + 1
    places = texts.where(F.size("tokens") >= shortest).select(
        key, "tokens", F.explode(F.sequence(F.lit(0), n * F.size("tokens") - 1)).alias("i"))
    places = places.withColumns({"at": F.expr(f"i div {n}").cast("int"), "mask": (F.col("i") % n).cast("int")})

    def seed(code):
        return F.xxhash64(F.lit(code), *[F.get("tokens", F.col("at") + o) for o in masks[code]])

    value = seed(codes[-1])
    fits = F.lit(masks[codes[-1]][-1])
    for i, code in enumerate(codes[:-1]):
        value = F.when(F.col("mask") == i, seed(code)).otherwise(value)
        fits = F.when(F.col("mask") == i, masks[code][-1]).otherwise(fits)
    return places.where(F.col("at") + fits < F.size("tokens")).select(key, "at", value.alias("seed"))


def _masks(sizes: list[int]) -> list[tuple[int, int, dict[int, tuple[int, ...]]]]:
    """(least size, greatest size, masks by code) of the items' classes; ``sizes``: of the items under ``WINDOW``."""
    found = [(WINDOW, 1 << 30, dict(enumerate(MASKS)))]
    if any(n >= LEAST for n in sizes):
        found.append((LEAST, WINDOW - 1, dict(enumerate(SHORT_MASKS, len(MASKS)))))
    return found + [(n, n, {-n: tuple(range(n))}) for n in sorted(sizes) if n < LEAST]


def _agreement(window: int):
    """Columns of an alignment of ``item`` at ``start`` in ``tokens``: equal places, and the most in a window."""
    same = F.zip_with("item", "piece", lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    add = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(F.size("same") - window, F.lit(0))),
                                   lambda o: add(F.slice("same", o + 1, window))))
    return same, add(F.col("same")), best


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 broadcast_rows: int = 2_000_000) -> DataFrame:
    """``docs(doc_id, text)``, ``benchmark(item_id, text)`` ->
    ``(doc_id, item_id, start, n_item, n_equal, best_window, overlap)``."""
    test = (benchmark.where("item_id is not null and text is not null").groupBy("item_id").agg(F.max("text").alias("text"))
            .select(F.col("item_id").cast("long"), tokens().alias("tokens")))
    train = (docs.where("doc_id is not null and text is not null")
             .select(F.col("doc_id").cast("long"), tokens().alias("tokens")))
    size = F.size("tokens")
    classes = _masks([r[0] for r in test.where((size > 0) & (size < WINDOW)).select(size).distinct().collect()])
    wanted, masks = None, {}
    for lo, hi, own in classes:
        part = seeds(test.where(size.between(lo, hi)), "item_id", own).withColumn("whole", F.lit(hi < LEAST))
        wanted, masks = part if wanted is None else wanted.union(part), masks | own
    wanted = wanted.withColumnRenamed("at", "item_at").distinct()
    small = wanted.limit(broadcast_rows + 1).count() <= broadcast_rows
    hits = seeds(train, "doc_id", masks).join(F.broadcast(wanted) if small else wanted, "seed")
    hits = hits.select("doc_id", "item_id", "whole", (F.col("at") - F.col("item_at")).alias("start"))
    aligned = written(hits.groupBy("doc_id", "item_id", F.when(~F.col("whole"), F.col("start")).alias("apart"))
                      .agg(F.min("start").alias("start")).drop("apart"), "alignments")
    items = test.select("item_id", F.col("tokens").alias("item"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    pairs = (aligned.join(source, "doc_id").join(F.broadcast(items) if small else items, "item_id")
             .select("doc_id", "item_id", "start", "item", tokens().alias("tokens")))
    # a start before the document's first token is padded, so that both pieces stay in step
    piece = F.concat(F.array_repeat(F.lit(None).cast("string"), F.greatest(-F.col("start"), F.lit(0))),
                     F.slice("tokens", F.greatest(F.col("start"), F.lit(0)) + 1,
                             F.greatest(F.size("item") + F.least(F.col("start"), F.lit(0)), F.lit(0))))
    same, equal, best = _agreement(window)
    judged = (pairs.withColumn("piece", piece).withColumn("same", same)
              .select("doc_id", "item_id", "start", F.size("item").alias("n_item"),
                      equal.alias("n_equal"), best.alias("best_window"))
              .where(F.col("best_window") >= F.when(F.col("n_item") < LEAST, F.col("n_item"))
                     .otherwise(F.ceil(0.8 * F.least(F.col("n_item"), F.lit(window))))))
    top = judged.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("best_window", "n_equal", (-F.col("start")).alias("near"), "n_item")).alias("t"))
    return top.select("doc_id", "item_id", (-F.col("t.near")).cast("long").alias("start"),
                      F.col("t.n_item").cast("long").alias("n_item"), F.col("t.n_equal").cast("long").alias("n_equal"),
                      F.col("t.best_window").cast("long").alias("best_window"),
                      (F.col("t.n_equal") / F.col("t.n_item")).alias("overlap"))
