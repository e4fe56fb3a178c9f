import math
from collections import Counter, defaultdict

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizer, Tokenizer
from pyspark.sql import functions as F

from tagwright.operators import bayes, labels, terms
from tagwright.plans import relations
from tagwright.plans.model_store import ModelStore
from tagwright.plans.training import train_hashed
from tests.conftest import MIDDLE

POSTS = [
    ("1", "the cat sat on the mat"),
    ("2", "a dog ran  far"),
    ("3", "the dog sat"),
    ("4", "birds fly far far away"),
    ("5", "cat and dog"),
    ("6", None),
]
TAGS = [("1", "cat"), ("2", "dog"), ("3", "dog"), ("3", "cat"), ("4", "bird"), ("5", "cat"), ("5", "cat"), ("6", "dog")]
NEW = [("n1", "the cat"), ("n2", "far away birds"), ("n3", "unknown words only"), ("n4", "   "), ("n5", "dog dog dog the")]
CLASSES = [(0, "cat"), (1, "empty"), (2, "dog"), (3, "bird")]


def frame(spark, rows, schema="Id STRING, Body STRING"):
    return spark.createDataFrame(rows, schema)


def fitted(spark, **more):
    vocab = labels.class_table(CLASSES, spark)
    return bayes.fit_bayes(frame(spark, POSTS), frame(spark, TAGS, "Id STRING, Tag STRING"), vocab, **more)


def by_hand(smoothing=1.0):
    """Scores of the new posts by the plain formula, in Python."""
    texts = {post: text.split(" ") for post, text in POSTS if text is not None}
    rows = [(tag, Counter(texts[post])) for post, tag in TAGS if post in texts]
    df = Counter(word for _, counted in rows for word in counted)
    idf = {word: math.log((len(rows) + 1) / (n + 1)) for word, n in df.items()}
    weight = defaultdict(Counter)
    for tag, counted in rows:
        for word, n in counted.items():
            weight[tag][word] += n * idf[word]
    priors = Counter(tag for tag, _ in rows)
    scores = {}
    for post, text in NEW:
        for cat_id, tag in CLASSES:
            if tag not in priors:
                continue
            total = math.log(sum(weight[tag].values()) + len(df) * smoothing)
            score = math.log(priors[tag] + smoothing) - math.log(len(rows) + len(priors) * smoothing)
            for word in text.split(" ") if text.strip() else []:
                if word in idf:
                    score += idf[word] * (math.log(weight[tag][word] + smoothing) - total)
            scores[post, cat_id] = score
    return scores


@pytest.mark.parametrize("smoothing", [1.0, 0.3])
def test_scores_by_hand(spark, smoothing):
    scored = fitted(spark, smoothing=smoothing).score_rows(frame(spark, NEW)).collect()
    found = {(row["Id"], row["CatId"]): row["score"] for row in scored}
    expected = by_hand(smoothing)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[key], expected[key], abs_tol=1e-9) for key in expected)


def test_predictions_by_hand(spark):
    expected = by_hand()
    names = dict(CLASSES)
    for row in fitted(spark).predict(frame(spark, NEW)).collect():
        scores = {cat_id: score for (post, cat_id), score in expected.items() if post == row["Id"]}
        best = max(scores, key=lambda cat_id: (scores[cat_id], -cat_id))
        assert (row["CatId"], row["tags"]) == (best, names[best])
        share = math.exp(scores[best]) / sum(math.exp(score) for score in scores.values())
        assert math.isclose(row["confidence"], share, abs_tol=1e-9)


def test_classes_without_rows_never_win(spark):
    assert fitted(spark).class_ids == [0, 2, 3]


def test_posts_without_known_words_get_the_prior(spark):
    rows = {row["Id"]: row["tags"] for row in fitted(spark).predict(frame(spark, NEW)).collect()}
    assert rows["n3"] == rows["n4"] == "cat"


def test_bad_fits_are_refused(spark):
    with pytest.raises(ValueError):
        fitted(spark, smoothing=0.0)
    with pytest.raises(ValueError):
        bayes.fit_bayes(
            frame(spark, POSTS), frame(spark, TAGS, "Id STRING, Tag STRING"), labels.class_table([(0, "none")], spark)
        )


def test_model_too_large_to_broadcast(spark):
    """Some terms hot, most joined by shuffle: the scores stay the same."""
    training, held = labels.split_by_key(relations.posts(spark, MIDDLE))
    model = bayes.fit_bayes(training, relations.tags(spark, MIDDLE), relations.vocab(spark, MIDDLE))
    whole = {row["Id"]: row["scores"] for row in model.scores(held).collect()}
    parts = {row["Id"]: row["scores"] for row in model.scores(held, max_broadcast=20_000).collect()}
    assert whole.keys() == parts.keys()
    for post, scores in whole.items():
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(scores, parts[post]))


def test_agrees_with_mllib(spark):
    """The same class as MLlib's Naive Bayes over the exact vocabulary, for every held-out document."""
    training, held = labels.split_by_key(relations.posts(spark, MIDDLE))
    tags, vocab = relations.tags(spark, MIDDLE), relations.vocab(spark, MIDDLE)
    ours = {row["Id"]: row["CatId"] for row in bayes.fit_bayes(training, tags, vocab).predict(held).collect()}

    rows = labels.with_class(labels.training_rows(tags, training, vocab), vocab)
    split = Tokenizer(inputCol="Body", outputCol="Words")
    counted = CountVectorizer(inputCol="Words", outputCol="Features").fit(split.transform(rows))
    features = counted.transform(split.transform(rows))
    weighted = IDF(inputCol="Features", outputCol="Weights").fit(features)
    model = NaiveBayes(labelCol="CatId", featuresCol="Weights").fit(weighted.transform(features))
    scored = model.transform(weighted.transform(counted.transform(split.transform(held))))
    theirs = {row["Id"]: int(row["prediction"]) for row in scored.select("Id", "prediction").collect()}
    assert ours == theirs


def test_log_likelihoods_sum_to_one(spark):
    model = fitted(spark)
    seen = F.count("term")
    lacking = F.max(F.when(F.col("term").isNull(), F.exp("log_likelihood"))) * (model.terms.n_terms - seen)
    total = F.sum(F.when(F.col("term").isNotNull(), F.exp("log_likelihood"))) + lacking
    sums = model.log_likelihoods().groupBy("CatId").agg(total.alias("p")).collect()
    assert len(sums) == 3 and all(math.isclose(row["p"], 1.0, rel_tol=1e-9) for row in sums)


def test_null_terms_stay_in_place(spark):
    """Beyond the bound for broadcasts, only tokens with a term are joined by shuffle."""
    posts = frame(spark, NEW)
    plan = fitted(spark).scores(posts, max_broadcast=0)._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join LeftAnti") :]
    assert "isnotnull" in joined and fitted(spark).scores(posts, max_broadcast=0).count() == len(NEW)


def test_many_classes(spark, tmp_path):
    """12,000 classes fit, are stored and score as the plain formula does."""
    n = 12_000
    posts = spark.range(n).select(
        F.col("id").cast("string").alias("Id"), F.concat(F.lit("w"), F.col("id"), F.lit(" same")).alias("Body")
    )
    tags = spark.range(n).select(F.col("id").cast("string").alias("Id"), F.concat(F.lit("t"), F.col("id")).alias("Tag"))
    vocab = labels.class_table([(at, f"t{at}") for at in range(n)], spark)
    store = ModelStore(spark, str(tmp_path / "models"))
    model = store.load(store.publish(bayes.fit_bayes(posts, tags, vocab)))
    new = frame(spark, [(str(at), f"w{at} w{at}") for at in range(0, n, 599)] + [("x", "nothing")])
    found = {row["Id"]: (row["tags"], row["confidence"]) for row in model.predict(new).collect()}
    idf = math.log((n + 1) / 2)
    gain = math.exp(2 * idf * math.log(idf + 1))
    assert found.pop("x") == ("t0", pytest.approx(1 / n))
    assert found.keys() == {str(at) for at in range(0, n, 599)}
    assert all(tag == f"t{post}" and math.isclose(p, gain / (gain + n - 1)) for post, (tag, p) in found.items())


def test_model_of_a_few_posts_gives_the_same_scores(spark):
    model, new = fitted(spark), frame(spark, NEW)
    part = model.only(new)
    assert part.terms.n_bytes < model.terms.n_bytes
    assert sorted(part.score_rows(new).collect()) == sorted(model.score_rows(new).collect())


def test_a_batch_reads_the_buckets_of_its_terms(spark, tmp_path):
    """Of a stored model in buckets only those are read into which the batch's rare terms fall."""
    store = ModelStore(spark, str(tmp_path / "models"), bucket_bytes=100)
    model = store.load(store.publish(fitted(spark)))
    assert model.terms.buckets > 8
    wanted = frame(spark, [("far",), ("cat",), ("unknown",)], "term STRING")
    buckets = {row["b"] for row in wanted.select(terms.term_bucket(F.col("term"), model.terms.buckets).alias("b")).collect()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = model.terms.of_terms(wanted)
        assert sorted(row["term"] for row in found.collect()) == ["cat", "far"]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(at) for at in range(leaves.size()) if "FileScan" in leaves.apply(at).nodeName() or "Scan parquet" in leaves.apply(at).nodeName()]
    stored = {int(path.name.split("=")[1]) for path in tmp_path.glob("models/v=1/terms/bucket=*")}
    assert [scan.metrics().apply("numPartitions").value() for scan in scans] == [len(buckets & stored)]
    assert len(stored) > len(buckets)


@pytest.mark.parametrize("max_bytes", [0, 200, 10**6])
def test_terms_in_place_are_not_looked_up(spark, tmp_path, max_bytes):
    store = ModelStore(spark, str(tmp_path / "models"), bucket_bytes=100)
    model, new = store.load(store.publish(fitted(spark))), frame(spark, NEW)
    in_place = model.kept_in_place(max_bytes)
    assert (in_place.count() == 0) == (max_bytes == 0) and in_place.count() <= model.terms.n_terms
    part = model.only(new, in_place)
    assert sorted(part.score_rows(new).collect()) == sorted(fitted(spark).score_rows(new).collect())


def test_slots_agree_with_mllib(spark, tmp_path):
    """The model over hashed slots gives every held-out document the class and probabilities of MLlib's."""
    training, held = labels.split_by_key(relations.posts(spark, MIDDLE))
    tags, vocab = relations.tags(spark, MIDDLE), relations.vocab(spark, MIDDLE)
    store = ModelStore(spark, str(tmp_path / "models"))
    sparse = store.load(store.publish(bayes.fit_slots(training, tags, vocab, slots=500)))
    found = {row["Id"]: (row["tags"], row["confidence"]) for row in sparse.predict(held).collect()}
    dense = train_hashed(training, tags, vocab, slots=500).predict(held, confidence=True)
    expected = {row["Id"]: (row["tags"], row["confidence"]) for row in dense.collect()}
    assert found.keys() == expected.keys()
    for post, (tag, share) in expected.items():
        assert found[post][0] == tag and math.isclose(found[post][1], share, rel_tol=1e-6)


def test_slots_of_many_classes(spark):
    """12,000 classes over 20,000 slots, a product that a dense model refuses: fitted and scored by the plain formula."""
    n, slots = 12_000, 20_000
    posts = spark.range(n).select(
        F.col("id").cast("string").alias("Id"), F.concat(F.lit("w"), F.col("id"), F.lit(" same")).alias("Body")
    )
    tags = spark.range(n).select(F.col("id").cast("string").alias("Id"), F.concat(F.lit("t"), F.col("id")).alias("Tag"))
    vocab = labels.class_table([(at, f"t{at}") for at in range(n)], spark)
    with pytest.raises(ValueError, match="12000 classes and 20000 slots"):
        train_hashed(posts, tags, vocab, slots=slots)
    model = bayes.fit_slots(posts, tags, vocab, slots=slots)
    names = [f"w{at}" for at in range(0, n, 599)]
    hashed = terms.hashed_features(frame(spark, [(f"w{at}", f"w{at}") for at in range(n)] + [("same", "same"), ("x", "zzz")]), slots)
    slot = {row["Id"]: int(row["slot"]) for row in terms.vector_entries(hashed, "Features", "Id").collect()}
    own = [Counter([slot[f"w{at}"], slot["same"]]) for at in range(n)]
    df = Counter(one for counted in own for one in counted)
    idf = lambda one: math.log((n + 1) / (df[one] + 1))
    weights = [{one: tf * idf(one) for one, tf in counted.items()} for counted in own]
    totals = [math.log(sum(weight.values()) + slots) for weight in weights]
    new = frame(spark, [(name, f"{name} zzz") for name in names])
    found = {row["Id"]: row["tags"] for row in model.predict(new).collect()}
    for name in names:
        asked = Counter([slot[name], slot["x"]])
        scores = [
            sum(tf * idf(one) * (math.log(weight.get(one, 0.0) + 1) - total) for one, tf in asked.items())
            for weight, total in zip(weights, totals)
        ]
        best = max(scores)
        assert scores[int(found[name][1:])] == pytest.approx(best, abs=1e-9)
    assert found.keys() == set(names)


def test_gains_are_added_up_before_they_leave_a_task(spark):
    """Frequent terms give one row for a post and class, in any blocks, not one for each of their classes."""
    model, posts = fitted(spark), frame(spark, NEW)
    expected = sorted(model.score_rows(posts).collect())
    parts = bayes.gain_sums(
        model.rows_of(posts, "Id").coalesce(1),
        model.terms.rows.select("term", "idf", F.transform("seen", lambda c: F.struct(c["place"], c["n"].cast("double").alias("g"))).alias("gains")),
        None,
    )
    rows = [(row["Id"], row["place"]) for row in parts.collect()]
    assert len(rows) == len(set(rows)) and {post for post, place in rows if place is None} == {post for post, _ in NEW}
    assert sorted(model.score_rows(posts).collect()) == expected
