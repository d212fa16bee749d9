"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text's k-mers are its runs of k words, each numbered by how often it occurred before. A hash of
k-mer and number deals them into bins and orders them in each bin; the l smallest of a bin, put back
into text order, are hashed as a tuple. Moving, cutting or repeating passages changes tuples even
where the set of k-mers stays, as it does the edit distance. Likeness is the share of equal bins
among those filled in either text.

A null text counts as empty; texts without words have an empty fingerprint, and two such are alike
(1.0). A text of fewer than k words is one k-mer. Equal texts have equal fingerprints. Ties of k-mers
are settled by their numbers. Rows of one id are ordered by text; a null id comes first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, BINS, TUPLE = 3, 64, 2
#: Low bits of a packed number that hold a k-mer's place.
PLACE_BITS = 26
FIRST_ID = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value that is used many times, so that it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sketch(text: Column, k: int = K, bins: int = BINS, size: int = TUPLE) -> Column:
    """array<int>: for each filled bin, bin number and 16 bits of the hash of its tuple."""
    mask = (1 << PLACE_BITS) - 1

    def numbered(s: Column) -> Column:
        # s: k-mer hash and place, sorted; runs of one hash start where the hash changes.
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.shiftright(F.get(s, i), PLACE_BITS) != F.shiftright(F.get(s, i - 1), PLACE_BITS)),
        )
        stops = let(starts, lambda a: F.flatten(F.transform(
            a, lambda x, j: F.sequence(F.lit(0), F.coalesce(F.get(a, j + 1), F.size(s)) - x - 1)
        )))
        return F.sort_array(F.zip_with(
            s, stops, lambda x, n: F.xxhash64(F.shiftright(x, PLACE_BITS), n).bitwiseAND(F.lit(~mask)).bitwiseOR(x.bitwiseAND(F.lit(mask)))
        ))

    shift = 64 - (bins - 1).bit_length()
    bin_of = lambda x: F.shiftrightunsigned(x, shift)

    def tuples(t: Column) -> Column:
        # t: hash and place, sorted, so that each bin is a run; keep the first `size` of each.
        least = F.filter(t, lambda x, i: (i < size) | (bin_of(F.get(t, i - size)) != bin_of(x)))

        def hashed(a: Column) -> Column:
            heads = F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (bin_of(F.get(a, i)) != bin_of(F.get(a, i - 1))))
            return F.transform(heads, lambda i: let(
                F.filter(F.slice(a, i + 1, size), lambda x: bin_of(x) == bin_of(F.get(a, i))),
                lambda own: (bin_of(F.get(a, i)) * 65536 + F.pmod(F.xxhash64(F.transform(
                    F.array_sort(F.transform(own, lambda x: F.struct(x.bitwiseAND(F.lit(mask)).alias("p"), F.shiftright(x, PLACE_BITS).alias("h")))),
                    lambda x: x["h"],
                )), F.lit(65536))).cast("int"),
            ))

        return let(least, hashed)

    def kmers(w: Column) -> Column:
        n = F.greatest(F.size(w) - (k - 1), F.lit(1))
        return F.sort_array(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
                                        .bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))

    words = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    empty = F.array().cast("array<int>")
    return let(words, lambda w: F.when(F.size(w) == 0, empty).otherwise(let(kmers(w), lambda s: let(numbered(s), tuples))))


def likeness(a: Column, b: Column) -> Column:
    """Equal bins over bins filled in either sketch."""
    part = lambda x: F.transform(x, lambda v: F.shiftright(v, 16))
    both = F.size(F.array_intersect(part(a), part(b)))
    filled = F.size(a) + F.size(b) - both
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def as_text(sketch_: Column) -> Column:
    """Six hexadecimal digits for each filled bin: its number and its hash."""
    return F.array_join(F.transform(sketch_, lambda v: F.lpad(F.hex(v), 6, "0")), "")


def with_next(docs: DataFrame, text: str = "text", parts: int | None = None) -> tuple[DataFrame, Window]:
    """Rows (doc_id, text, bucket, extra) and the window in which the next row is the next document.

    Quantiles of the ids, which are ids themselves, cut the table into buckets; the first
    documents of a bucket also end the one before it, as `extra` rows, and those of the first bucket
    end the last. So no window covers more than one bucket.
    """
    n = parts or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID))
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"), key.alias("k"))
    edges = rows.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 100 * n), F.min("k")).first()
    cuts = sorted({edges[1], *(edges[0] or [])} - {None}) or [0]
    held = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    bucket = F.size(F.filter(held, lambda e: e <= F.col("k"))) - 1
    last = len(cuts) - 1
    first = F.array_contains(held, F.col("k"))
    before = F.when(F.col("b") == 0, F.lit(last)).otherwise(F.col("b") - 1)
    turn = F.when(F.col("b") == 0, 1).otherwise(0)
    at = F.when(F.col("first"), F.array(
        F.struct(F.col("b").alias("bucket"), F.lit(False).alias("extra"), F.lit(0).alias("turn")),
        F.struct(before.alias("bucket"), F.lit(True).alias("extra"), turn.alias("turn")),
    )).otherwise(F.array(F.struct(F.col("b").alias("bucket"), F.lit(False).alias("extra"), F.lit(0).alias("turn"))))
    spread = rows.select("*", bucket.alias("b"), first.alias("first")).select("doc_id", "text", "k", F.inline(at))
    return spread, Window.partitionBy("bucket").orderBy("turn", "k", "extra", "text")


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows, window = with_next(docs, text)
    after = F.lead("text").over(window)
    n = F.char_length("text")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 4) as int))"),
                      F.expr("left(after, cast(floor(char_length(text) / 4) as int))"))
    made = rows.withColumn("after", F.coalesce(after, F.col("text"))).withColumn("edited", edited).select(
        "doc_id", "k", "bucket", "turn", "extra", "text", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("f"), F.when(~F.col("extra"), sketch(F.col("edited"))).alias("e"),
    )
    full = made.withColumn("next", F.coalesce(F.lead("f").over(window), F.col("f"))).where("not extra")
    return full.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("f")).alias("fingerprint"), as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("next")).alias("near_next"),
    )
