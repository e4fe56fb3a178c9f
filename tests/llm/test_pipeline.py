"""The stages of the pipeline, each on what its predecessor kept."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tagwright.llm import encoding, langid, mixing, simhash
from tagwright.llm.queries import TOKENIZER
from tagwright.session import written
from tests.conftest import SMALL
from tests.llm.test_operators import brute_components, slow_fingerprint, slow_measures


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SMALL), f"test-{name.replace(' ', '-')}"))
    assert all(frame.columns == names for frame in frames[:-1])
    given, spoken, good, single, mixed = ([row for row in frame.collect()] for frame in frames[:-1])
    assert {row["doc_id"] for row in spoken} == {row["doc_id"] for row in given}  # all have letters and a language

    def fails(text):
        m = slow_measures(text)
        return (
            m["n_words"] < 50
            or 100 * m["n_repeat_words"] > 50 * m["n_words"]
            or 10 * m["n_symbols"] > m["n_words"]
            or 10 * m["n_marks"] > 3 * m["n_words"]
            or not 2 * m["n_words"] <= m["word_chars"] <= 20 * m["n_words"]
            or 100 * m["n_dup_lines"] > 35 * m["n_lines"]
        )

    assert {row["doc_id"] for row in good} == {row["doc_id"] for row in spoken if not fails(row["text"])}
    good.sort(key=lambda row: row["doc_id"])
    roots = brute_components([slow_fingerprint(row["text"]) for row in good], 2)
    assert {row["doc_id"] for row in single} == {good[root]["doc_id"] for root in roots}
    times = Counter(row["doc_id"] for row in mixed)
    assert set(times) <= {row["doc_id"] for row in single} and max(times.values()) <= 2
    words = {row["doc_id"]: slow_measures(row["text"])["n_words"] for row in single}
    assert abs(sum(words[key] * n for key, n in times.items()) / sum(words.values()) - 1.5) < 0.2
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {row["doc_id"]: tokenizer.encode(row["text"], add_special_tokens=False).ids for row in single}
    digest = lambda key: hashlib.sha256(np.array(ids[key], "<u4").tobytes()).hexdigest()
    expected = Counter((key, len(ids[key]), digest(key)) for key in times.elements())
    assert Counter((row["doc_id"], row["n_tokens"], row["ids_sha256"]) for row in frames[-1].collect()) == expected


def test_repeated_rows_share_their_epochs(spark):
    """Copies of a row do not multiply what the mix takes of it."""
    rows = [(7, "a b c d", "s", at) for at in range(10)] + [(None, "x y", None, at) for at in range(7)]
    rows += [(at, f"word number {at}", "s", 0) for at in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long").repartition(3)
    expected = mixing.mix(mixing.described(docs), ["doc_id"], "size", "quality")
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    times = Counter((row["doc_id"], row["n"]) for row in found.collect())
    assert sum(times.values()) == expected.agg(F.sum("epochs")).first()[0]
    for key, copies in ((7, 10), (None, 7)):
        own = [times[key, at] for at in range(copies)]
        assert sum(own) == expected.where(F.col("doc_id").eqNullSafe(F.lit(key))).agg(F.sum("epochs")).first()[0]
        assert max(own) - min(own) <= 1


def test_no_text_is_lost_to_a_repeated_id(spark):
    """Rows that repeat an id are judged by their own texts."""
    a, b = "one text of some words that are here", "quite another text with none of those in it at all"
    docs = spark.createDataFrame([(3, a, 1), (5, a, 2), (5, b, 3), (5, b, 0), (None, a, 4), (None, "third text", 5)], "doc_id long, text string, n long")
    kept = simhash.one_of_each(docs).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(3, a, 1), (5, b, 0), (None, "third text", 5)], key=str)
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_marks_are_no_letters(spark):
    docs = spark.createDataFrame([("en", "plain words and more"), ("en", "plain words and more"), (None, "\u0301\u0301\u0301 12")], "lang string, text string")
    model = langid.fit_languages(docs)
    found = {row["text"]: (row["lang_pred"], row["score"]) for row in langid.identify(docs, model).collect()}
    assert found["\u0301\u0301\u0301 12"] == ("und", 0.0) and found["plain words and more"][0] == "en"


def test_both_passes_of_the_encoding_read_one_order(spark, tmp_path, monkeypatch):
    """Rows of a task that come in another order the second time would meet the words of others."""
    texts = [(at, f"text {at} of many, " + "word " * (at % 9)) for at in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    plain, turn = encoding.coded, []

    def shuffled(source, *more):
        turn.append(source)
        assert "Sort" in source._jdf.queryExecution().executedPlan().toString()
        return plain(source, *more)

    monkeypatch.setattr(encoding, "coded", shuffled)
    for row in encoding.encode(docs, TOKENIZER).collect():
        assert np.frombuffer(row["ids"], "<u4").tolist() == tokenizer.encode(texts[row["doc_id"]][1], add_special_tokens=False).ids
    assert len(turn) == 2
