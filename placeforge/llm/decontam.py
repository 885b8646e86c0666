"""Benchmark decontamination with a broadcast hash set of test n-grams; DataFrame functions only.

Texts are lower-cased (A-Z), cut into words, and every position of every document is keyed by a hash of
its next words. The distinct windows of the benchmark are the hash set. While they take at most BROADCAST_BYTES they
go to every executor, keyed by their first words, and a key that matches is verified word by word in place. Beyond that
the positions' keys, each over a whole window and without the text, are joined by a shuffle; what matches goes back to
its document for its words, which are then joined with the windows themselves. So hash collisions change nothing.

Defined results: null texts have no words and no hits; an item without words has no window, one with fewer
words than the window is one window. Repeated rows get equal results (a row is known by doc_id and text
hash). An empty benchmark leaves all clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import durable

WINDOW = 13
#: Words whose hash is looked up before a window is verified.
KEY_WORDS = 5
#: The most bytes of windows that are broadcast.
BROADCAST_BYTES = 64 << 20
#: The most document keys (16 bytes each) that a clean-up broadcasts to drop rows.
BROADCAST_KEYS = 2_000_000
#: A document is contaminated when 20 times its hit words reach its words.
SHARE = 20

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spaced(text: str) -> Column:
    """The normalised words of a text column with single spaces between them; empty for null and wordless texts."""
    t = F.coalesce(F.col(text), F.lit(""))
    # Where all is ASCII the plain function lower-cases the same letters, and faster.
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, _UP, _LOW))
    return F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def words(text: str) -> Column:
    """The normalised words of a text column; an empty array for null and wordless texts."""
    s = spaced(text)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " ", -1))


def with_word_count(documents: DataFrame) -> DataFrame:
    """doc_id, text hash and n_words; counting spaces is cheaper than cutting."""
    s = documents.select("doc_id", F.xxhash64("text").alias("th"), spaced("text").alias("s"))
    n = F.octet_length("s") - F.octet_length(F.replace(F.col("s"), F.lit(" "), F.lit(""))) + 1
    return s.select("doc_id", "th", F.when(F.col("s") == "", 0).otherwise(n).cast("long").alias("n_words"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """gram (array of words) and items (sorted ids as strings) of every distinct window of the benchmark."""
    w = benchmark.select("item_id", words("text").alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    at = w.select("item_id", "w", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("at"))
    grams = at.select(F.col("item_id").cast("string").alias("item"), F.slice("w", F.col("at"), F.col("n")).alias("gram"))
    return grams.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items"))


def matches_in_place(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """doc_id, th, pos, len and items of every occurrence of a window; the windows are broadcast, no text moves."""
    k = F.least(F.size("gram"), F.lit(KEY_WORDS))
    sizes = sorted(r["k"] for r in grams.select(k.alias("k")).distinct().collect())  # at most KEY_WORDS rows
    if not sizes:
        return docs.select("doc_id", "th", F.lit(0).alias("pos"), F.lit(0).alias("len"), F.array().cast("array<string>").alias("items")).filter(F.lit(False))
    at = docs.select("doc_id", "th", "w", F.posexplode("w").alias("pos", "first"))

    def key(n: int):
        return F.when(F.col("pos") <= F.size("w") - n, F.xxhash64(F.lit(n), "first", *[F.get("w", F.col("pos") + j) for j in range(1, n)]))

    if len(sizes) == 1:
        at = at.filter(F.col("pos") <= F.size("w") - sizes[0]).withColumn("key", F.xxhash64(F.lit(sizes[0]), "first", *[F.get("w", F.col("pos") + j) for j in range(1, sizes[0])]))
    else:  # one pass over the texts for all sizes
        at = at.select("doc_id", "th", "w", "pos", F.explode(F.array(*[key(n) for n in sizes])).alias("key"))
    own = F.coalesce(*[F.when(k == n, F.xxhash64(F.lit(n), *[F.get("gram", F.lit(j)) for j in range(n)])) for n in sizes])
    found = at.join(F.broadcast(grams.select(own.alias("key"), "gram", "items")), "key")
    same = F.slice("w", F.col("pos") + 1, F.size("gram")) == F.col("gram")
    return found.filter(same).select("doc_id", "th", "pos", F.size("gram").alias("len"), "items")


def matches_by_shuffle(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """The same for any number of windows; what is shuffled has no text but the windows that match."""
    sizes = sorted(r["n"] for r in grams.select(F.size("gram").alias("n")).distinct().collect())  # at most `window` rows
    keys = grams.select(F.size("gram").alias("len"), F.xxhash64("gram").alias("key")).distinct()
    at = docs.select("doc_id", "th", "w", F.posexplode("w").alias("pos", "first"))
    key = lambda n: F.when(F.col("pos") <= F.size("w") - n, F.struct(F.lit(n).alias("len"), F.xxhash64(F.slice("w", F.col("pos") + 1, n)).alias("key")))
    # Plain explodes stay in generated code, where a text isn't copied for each of its positions.
    at = at.select("doc_id", "th", "pos", F.explode(F.array(*[key(n) for n in sizes])).alias("k")).filter("k is not null").select("doc_id", "th", "pos", "k.len", "k.key")
    found = at.join(keys, ["len", "key"]).select(F.col("doc_id").alias("d2"), F.col("th").alias("t2"), "pos", "len")
    again = docs.join(found, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")))
    again = again.select("doc_id", "th", "pos", "len", F.slice("w", F.col("pos") + 1, F.col("len")).alias("gram"))
    return again.join(grams, "gram").select("doc_id", "th", "pos", "len", "items")


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int | None = None) -> DataFrame:
    """doc_id, text hash, and for each document with hits: n_hit, the sorted items and the spans of words."""
    grams = durable(item_windows(benchmark, window), "windows")
    size = grams.agg(F.coalesce(F.sum(F.octet_length(F.array_join("gram", " ")) + F.octet_length(F.array_join("items", " ")) + 100), F.lit(0))).first()[0]
    docs = documents.select("doc_id", F.xxhash64("text").alias("th"), words("text").alias("w"))
    rows = (matches_in_place if size <= (BROADCAST_BYTES if most is None else most) else matches_by_shuffle)(docs, grams)
    per = rows.groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_set(F.struct("pos", "len"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["pos"] + s["len"] - F.greatest(s["pos"], a["end"]))).alias("n"),
            F.greatest(a["end"], s["pos"] + s["len"]).alias("end"),
        ),
    )
    return per.select("doc_id", "th", covered["n"].cast("long").alias("n_hit"), "items", "spans")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each row of documents."""
    own = with_word_count(documents)
    h = hits(documents, benchmark, window).select(F.col("doc_id").alias("d2"), F.col("th").alias("t2"), "n_hit", "items")
    out = own.join(h, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def drop_rows(documents: DataFrame, bad: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """documents without the rows whose (doc_id, text hash) is in bad; texts stay in place while bad is small."""
    free = "_" * (1 + max(map(len, documents.columns)))  # no column of documents starts like this
    d, t = f"{free}d", f"{free}t"
    keys = durable(bad.select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct(), "dropped")
    small = keys.count() <= most
    on = documents["doc_id"].eqNullSafe(F.col(d)) & (F.xxhash64(documents["text"]) == F.col(t))
    return documents.join(F.broadcast(keys) if small else keys, on, "left_anti")


def bad_rows(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and text hash of the contaminated rows."""
    h = hits(documents, benchmark, window).select(F.col("doc_id").alias("d2"), F.col("th").alias("t2"), "n_hit")
    own = with_word_count(documents)
    both = own.join(h, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")))
    return both.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select("doc_id", "th")


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """documents without the contaminated rows; the others stay as they are."""
    return drop_rows(documents, bad_rows(documents, benchmark, window))
