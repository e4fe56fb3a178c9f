"""Words, term frequencies and TF-IDF weights as long tables, and hashed as vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.fixed_values import BROADCAST_BYTES, HASH_SLOTS
from tagwright.functions.rows import filled
from tagwright.functions.text import inverse_frequency, term_rows, words
from tagwright.session import fits_broadcast, written

# What a row of a term table takes up besides the term and its arrays, in bytes.
ROW_OVERHEAD = 64


def term_bucket(term: Column, buckets: int) -> Column:
    """The bucket of a term in a stored table."""
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def tokenize(posts: DataFrame) -> DataFrame:
    return filled(posts, "Body").withColumn("Words", words(F.col("Body")))


def term_frequency(posts: DataFrame) -> DataFrame:
    """``(Id, term, tf)`` for each distinct word of each post."""
    complete = filled(posts, "Body")
    return term_rows(complete, "Id").where("term IS NOT NULL")


def document_frequency(posts: DataFrame) -> DataFrame:
    """``(term, df)``, partly counted before the shuffle. The null term has the number of posts."""
    complete = filled(posts, "Body")
    return term_rows(complete).groupBy("term").agg(F.count("*").alias("df"))


@dataclass(frozen=True)
class TermTable:
    """A written table with one row per term, and its measured size.

    ``levels`` has the bytes of the terms whose ``df`` has 1, 2, 3... binary digits, 63 at most. A table in
    ``buckets`` is stored in folders by ``bucket``, a hash of the term, and its rows have that column.
    """

    rows: DataFrame
    n_terms: int
    levels: dict[int, int]
    buckets: int = 0

    @classmethod
    def measure(cls, rows: DataFrame, row_bytes: Column | int = ROW_OVERHEAD, buckets: int = 0) -> "TermTable":
        """Measure ``rows``, whose columns besides the term take ``row_bytes``."""
        size = F.sum(F.octet_length("term") + (F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes))
        levels = rows.groupBy(F.length(F.bin("df")).alias("bits")).agg(F.count("*").alias("n"), size.alias("n_bytes"))
        found = levels.collect()
        return cls(rows, sum(row["n"] for row in found), {row["bits"]: row["n_bytes"] for row in found}, buckets)

    @property
    def n_bytes(self) -> int:
        return sum(self.levels.values())

    def attach(self, tokens: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """Left join of ``tokens`` with this table on ``term``.

        A table within ``max_bytes`` is broadcast. Of a larger one the most frequent terms are
        broadcast, as many as fit, so that the bulk of the tokens stays in place; the other terms are rare
        ones, and only their tokens are shuffled. Tokens without a term stay in place too.
        """
        if self.n_bytes <= max_bytes:
            return tokens.join(F.broadcast(self.rows), "term", "left")
        hot = self.hot(max_bytes)
        in_place = tokens.join(F.broadcast(hot), "term", "left").where("df IS NOT NULL OR term IS NULL")
        return in_place.unionByName(self.attach_rare(tokens, hot))

    def attach_rare(self, tokens: DataFrame, hot: DataFrame) -> DataFrame:
        """Left join by shuffle of the ``tokens`` whose term is none of ``hot``."""
        rare = tokens.where("term IS NOT NULL").join(F.broadcast(hot.select("term")), "term", "left_anti")
        return rare.join(self.rows.hint("merge"), "term", "left")

    def hot(self, max_bytes: int) -> DataFrame:
        """All rows if they take ``max_bytes`` or less, else those of the most frequent terms that do."""
        if self.n_bytes <= max_bytes:
            return self.rows
        return self.rows.where(F.col("df") >= self.hot_df(max_bytes))

    def of_terms(self, wanted: DataFrame) -> DataFrame:
        """The rows of the terms of ``wanted`` (term, a written table of distinct ones).

        Of a table in buckets only those are read into which a wanted term falls. If ``wanted`` is small it is
        broadcast and the table stays in place.
        """
        rows = self.rows
        if self.buckets:
            hit = wanted.select(term_bucket(F.col("term"), self.buckets).alias("bucket")).distinct().collect()
            rows = rows.where(F.col("bucket").isin([row["bucket"] for row in hit]))
        if fits_broadcast(wanted, ROW_OVERHEAD + F.octet_length("term")):
            wanted = F.broadcast(wanted)
        return rows.join(wanted, "term", "left_semi")

    def hot_df(self, max_bytes: int) -> int:
        """The least power of two for which the terms of at least that ``df`` take ``max_bytes`` or less."""
        left, bits = max_bytes, 63
        while bits and self.levels.get(bits, 0) <= left:
            left -= self.levels.get(bits, 0)
            bits -= 1
        return 2**bits


def inverse_document_frequency(posts: DataFrame) -> TermTable:
    """``(term, df, idf)`` for the words of ``posts``, written to the shared folder."""
    counted = written(document_frequency(posts), "document-frequency")
    total = counted.where("term IS NULL").first()
    n_posts = total["df"] if total else 0
    known = counted.where("term IS NOT NULL")
    return TermTable.measure(
        known.withColumn("idf", inverse_frequency(F.lit(n_posts), F.col("df")))
    )


def tf_idf(posts: DataFrame, idf: TermTable) -> DataFrame:
    """``(Id, term, weight)``; words that ``idf`` does not know have no weight and go."""
    weighted = idf.attach(term_frequency(posts))
    return weighted.where("idf IS NOT NULL").select("Id", "term", (F.col("tf") * F.col("idf")).alias("weight"))


def hashed_features(posts: DataFrame, slots: int = HASH_SLOTS) -> DataFrame:
    """Add ``Features``, the counts of a post's words in ``slots`` hashed slots."""
    tokens = Tokenizer(inputCol="Body", outputCol="Words").transform(filled(posts, "Body"))
    hashed = HashingTF(inputCol="Words", outputCol="Features", numFeatures=slots).transform(tokens)
    return hashed.drop("Words")


def vector_entries(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """``(*keep, slot, value)`` for the stored slots of a sparse vector column."""
    stored = df.select(*keep, F.unwrap_udt(vector).alias("v"))
    entries = F.arrays_zip(F.col("v.indices").alias("slot"), F.col("v.values").alias("value"))
    return stored.select(*keep, F.explode_outer(entries).alias("e")).where("e IS NOT NULL").select(*keep, "e.*")


def slot_rows(posts: DataFrame, *keep: str, slots: int = HASH_SLOTS) -> DataFrame:
    """``(*keep, term, tf)`` for each hashed slot of each post, the slot as text, and one row with a null term per post."""
    stored = hashed_features(posts, slots).select(*keep, F.unwrap_udt("Features").alias("v"))
    entry = lambda slot, value: F.struct(slot.cast("string").alias("term"), value.cast("bigint").alias("tf"))
    entries = F.zip_with("v.indices", "v.values", entry)
    post = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("tf")))
    return stored.select(*keep, F.explode_outer(F.concat(entries, post)).alias("e")).select(*keep, "e.*")
