"""Document fingerprints (operator 11): bottom-k sketches, with DataFrame functions only.

A document's shingles are its runs of five words (the whole sequence if it has
fewer), in lower case. Its sketch is the `K` smallest distinct hashes of them, in
rising order. Sketches of parts merge to the sketch of the whole (the k smallest
of their union), so `merged` needs one bounded row per part and group, whatever
the size of a group. Two sketches give, over the k smallest hashes of their
union, the resemblance; with the distinct counts, which follow from the largest
hash kept, the containment. With fewer than k shingles all of them are exact.

Defined results: a null text counts as empty; a text without words has an empty
sketch, which resembles an empty one fully and others not at all. Equal texts
have equal sketches. Rows without an id are sketched like others; as they have
no place in the order of ids, their next document is the empty text. Rows with
the same id follow each other by the hash of their texts. An empty table gives no
rows. A text is held as an array of its words, so memory follows the longest text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, table, text_of

SHINGLE = 5
K = 128
# Hashes are numbers of this many bits, written as twelve hexadecimal digits.
BITS = 48
DIGITS = BITS // 4
# The order of ids is cut into this many parts for each shuffle partition, at most MOST_PARTS.
PARTS_EACH = 8
MOST_PARTS = 1 << 16


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space, in lower case."""
    spaced = F.translate(F.lower(text), "\t\n\x0b\x0c\r", " " * 5)
    return F.array_remove(F.split(spaced, " "), "")


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of a text's shingles in order, repeated ones included."""
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    # A let: the lambda's argument keeps the array from being computed once a shingle.
    runs = F.transform(
        F.array(hashes),
        lambda w: F.transform(
            F.when(F.size(w) > 0, F.sequence(F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(1)))).otherwise(
                F.array().cast("array<int>")
            ),
            lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(w, i, size)), 64 - BITS),
        ),
    )
    return runs[0]


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The k smallest distinct shingle hashes of a text, rising."""
    return smallest(shingles(text, size), k)


def written(hashes: Column) -> Column:
    """A sketch as text: fixed-width hexadecimal numbers in a row."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), DIGITS, "0")), "")


def read(fingerprint: Column) -> Column:
    """The sketch of a written fingerprint."""
    n = (F.length(fingerprint) / DIGITS).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        at, lambda i: F.conv(F.substring(fingerprint, i * DIGITS + 1, F.lit(DIGITS)), 16, 10).cast("long")
    )


def union(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either that both have; 1 for two empty sketches."""
    u = union(a, b, k)
    both = F.size(F.array_intersect(u, F.array_intersect(a, b)))
    return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(both / F.size(u))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    last = F.get(a, F.lit(k - 1))
    return F.when(last.isNull(), F.size(a).cast("double")).otherwise(F.lit(float((k - 1) << BITS)) / (last + 1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too, at most 1; 1 if a has none."""
    share = resemblance(a, b, k) * distinct_count(union(a, b, k), k) / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def merged(df: DataFrame, keys: list, column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of rows with sketches.

    Equal hashes combine before the shuffle and every task sends its k smallest of
    a group at most, so a group with a third of all rows is no large partition.
    Groups of nothing but empty sketches are kept, with an empty one.
    """
    h, place = fresh(df, "hash"), fresh(df, "place")
    rows = df.select(*keys, F.explode_outer(column).alias(h)).distinct()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.col(h).asc_nulls_last()))
    kept = rows.withColumn(place, rank).filter(F.col(place) <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list(h)).alias(column))


def fingerprints(docs: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """doc_id, sketch, fingerprint and estimated number of distinct shingles of every row."""
    one = docs.select("doc_id", sketch(text_of(docs), k, size).alias("sketch"))
    return one.select(
        "doc_id", "sketch", written(F.col("sketch")).alias("fingerprint"), distinct_count(F.col("sketch"), k).alias("n_distinct")
    )


def group_fingerprints(docs: DataFrame, by: str = "source", k: int = K, size: int = SHINGLE) -> DataFrame:
    """One fingerprint for all texts of each group, merged from those of its documents."""
    one = docs.select(F.col(by).alias("part_of"), sketch(text_of(docs), k, size).alias("sketch"))
    all_ = merged(one, ["part_of"], "sketch", k)
    return all_.select(
        F.col("part_of").alias(by), written(F.col("sketch")).alias("fingerprint"), distinct_count(F.col("sketch"), k).alias("n_distinct")
    )


def _parts(docs: DataFrame, count: int):
    """(ids at the cuts of the falling order, largest id): each cut is an id of the table."""
    shares = [i / count for i in range(1, count)] or [0.5]
    got = docs.agg(
        F.percentile_approx("doc_id", F.lit(shares), F.lit(10 * count)).alias("cuts"), F.max("doc_id").alias("top")
    ).first()
    return sorted(set(got["cuts"] or []), reverse=True), got["top"]


def with_next(docs: DataFrame, columns: list) -> DataFrame:
    """`docs` with `next_<column>` of the next document, by falling doc_id, after the last the first.

    Ids are cut into parts of like size; a part also gets copies of the first rows of
    the next one, so that every row finds its next in its own part, in one shuffle.
    """
    spark = docs.sparkSession
    count = min(MOST_PARTS, PARTS_EACH * max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts, top = _parts(docs, count)
    id_, bounds = F.col("doc_id"), F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    steps = [1 << b for b in range(len(cuts).bit_length() - 1, -1, -1)] or [1]
    # How many cuts are at or above the id, by binary search.
    part = F.aggregate(
        F.lit(steps), F.lit(0), lambda at, s: F.when(F.get(bounds, at + s - 1) >= id_, at + s).otherwise(at)
    )
    hash_ = F.xxhash64("text")
    rows = docs.withColumn("part", F.when(id_.isNotNull(), part).otherwise(-1 - F.pmod(hash_, F.lit(count)).cast("int")))
    row = lambda p, turn, own: F.struct(p.alias("part"), F.lit(turn).alias("turn"), F.lit(own).alias("own"))
    first_of_part = F.get(bounds, F.col("part") - 1) == id_
    places = F.array(
        row(F.col("part"), 0, True),
        F.when(first_of_part, row(F.col("part") - 1, 0, False)),
        F.when(id_ == F.lit(top).cast("long"), row(F.lit(len(cuts)), 1, False)),
    )
    rows = rows.withColumn("place", F.explode(F.array_compact(places))).select(*docs.columns, "place.*")
    order = W.partitionBy("part").orderBy("turn", F.desc_nulls_last("doc_id"), hash_)
    ahead = [F.lead(c).over(order).alias("next_" + c) for c in columns]
    rows = rows.select("*", *ahead).filter("own")
    return rows.select(*docs.columns, *[F.when(id_.isNotNull(), F.col("next_" + c)).alias("next_" + c) for c in columns])


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, the sketches of the text, its edited form and the next text, and the edited form.

    The edited form has the last third of the text replaced by the next document's
    beginning of the same length.
    """
    own = docs.select("doc_id", text_of(docs).alias("text")).withColumn("sketch", sketch(F.col("text")))
    both = with_next(own, ["text", "sketch"])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    new = F.concat(
        F.substring("text", F.lit(1), n - third), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third)
    )
    both = both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "sketch",
        F.coalesce("next_sketch", F.array().cast("array<bigint>")).alias("next_sketch"),
        new.alias("edited_text"),
    )
    return both.withColumn("edited_sketch", sketch(F.col("edited_text")))


def op11_fingerprints(spark, sf_dir):
    rows = edited(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"),
        written(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_count(F.col("sketch")).alias("n_distinct"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"),
    )
