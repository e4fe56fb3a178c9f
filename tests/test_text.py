from collections import Counter

from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from tagwright.fixed_values import HASH_SLOTS
from tagwright.functions.text import term_rows, words
from tagwright.operators import terms
from tagwright.session import spread

TEXTS = [
    " a  b ",
    "   ",
    "A\tB\n",
    "",
    "one",
    "x x y\x0bz\x0c\r\nx",
    "É è  É",
    "\n\nlead",
    "tail \t \n",
    "a b c",
    "b a b a b",
]


def posts(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "Id BIGINT, Body STRING")


def test_words_equal_the_tokenizer(spark):
    both = Tokenizer(inputCol="Body", outputCol="theirs").transform(posts(spark)).withColumn("ours", words(F.col("Body")))
    for row in both.collect():
        assert row["ours"] == row["theirs"], row["Body"]


def test_known_edges(spark):
    split = {row["Body"]: row["Words"] for row in terms.tokenize(posts(spark)).collect()}
    assert split[" a  b "] == ["", "a", "", "b"]
    assert split["   "] == []
    assert split["A\tB\n"] == ["a", "b"]
    assert split[""] == [""]


def test_posts_without_a_text_go(spark):
    assert [row["Id"] for row in terms.tokenize(posts(spark, [None, "a"])).collect()] == [1]
    assert [row["Id"] for row in terms.term_frequency(posts(spark, [None, "a"])).collect()] == [1]


def test_term_rows_count_words_and_posts(spark):
    tokens = {row["Id"]: row["Words"] for row in terms.tokenize(posts(spark)).collect()}
    rows = term_rows(posts(spark), "Id").collect()
    assert sorted(row["Id"] for row in rows if row["term"] is None) == sorted(tokens)
    for post, split in tokens.items():
        found = {row["term"]: row["tf"] for row in rows if row["Id"] == post and row["term"] is not None}
        assert found == Counter(split)


def test_counting_terms_does_not_shuffle(spark):
    plan = terms.term_frequency(posts(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rare_and_hot_terms_get_the_same_weights(spark):
    many = posts(spark, ["the cat", "the dog", "the the bird", "dog the", None])
    idf = terms.inverse_document_frequency(many)
    whole = sorted(terms.tf_idf(many, idf).collect())
    assert len(whole) == 8
    tokens = terms.term_frequency(many)
    for room, least in ((0, 8), (70, 4), (140, 2), (10_000, 1)):
        assert idf.hot_df(room) == least
        split = idf.attach(tokens, max_bytes=min(room, idf.n_bytes - 1))
        assert sorted(split.select("Id", "term", (F.col("tf") * F.col("idf")).alias("weight")).collect()) == whole


def murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3, 32 bits, as a signed number."""
    mask = 0xFFFFFFFF
    turn = lambda x, by: ((x << by) | (x >> (32 - by))) & mask
    mix = lambda k: turn(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    h, whole = seed, len(data) // 4 * 4
    for at in range(0, whole, 4):
        h = (turn(h ^ mix(int.from_bytes(data[at : at + 4], "little")), 13) * 5 + 0xE6546B64) & mask
    if data[whole:]:
        h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & mask
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hashed_slots(spark):
    hashed = terms.vector_entries(terms.hashed_features(posts(spark)), "Features", "Id").collect()
    for post, split in ((row["Id"], row["Words"]) for row in terms.tokenize(posts(spark)).collect()):
        expected = Counter(murmur3(word.encode()) % HASH_SLOTS for word in split)
        assert {row["slot"]: row["value"] for row in hashed if row["Id"] == post} == expected


def test_spread_only_splits_what_is_coarse(spark):
    cores = spark.sparkContext.defaultParallelism
    fine = spark.range(100, numPartitions=3 * cores)
    assert spread(fine, "id") is fine
    assert spread(spark.range(100, numPartitions=1), "id").rdd.getNumPartitions() == 2 * cores


def test_words_are_counted_as_they_are_split(spark):
    """Blocks of any size, all kinds of white space and letters that change in lower case: the words of the tokenizer, counted."""
    letters = " \t\n\r\x0b\f\0ab ÉİΣσẞ😀日\x1c\x85"
    texts = ["".join(letters[(at * at + 7 * k * at + k) % len(letters)] for k in range(at % 23)) for at in range(400)]
    given = posts(spark, TEXTS + texts)
    plan = term_rows(given, "Id")._jdf.queryExecution().executedPlan().toString()
    assert "sort_array" not in plan and "filter(" not in plan.lower()
    found = {}
    for row in term_rows(given, "Id").where("term IS NOT NULL").collect():
        found.setdefault(row["Id"], {})[row["term"]] = row["tf"]
    for row in given.select("Id", words(F.col("Body")).alias("split")).collect():
        assert found.get(row["Id"], {}) == Counter(row["split"])
