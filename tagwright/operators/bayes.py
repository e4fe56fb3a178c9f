"""Multinomial Naive Bayes over TF-IDF weights as joins and aggregates, with the exact vocabulary."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagwright.fixed_values import BROADCAST_BYTES, HASH_SLOTS, SMOOTHING
from tagwright.functions.rows import filled
from tagwright.functions.packed import added_up, buckets_of, cuts, pack, ranges, unpack
from tagwright.functions.text import Postings, class_lists, inverse_frequency, over_postings, term_rows
from tagwright.llm.common import lean, ship
from tagwright.operators.labels import class_list, class_table, labelled_posts, with_class
from tagwright.operators.terms import ROW_OVERHEAD, TermTable, slot_rows, term_bucket
from tagwright.session import given_bytes, new_folder, send, temporary, written


SEEN = "array<struct<place:int,n:bigint>>"
# Scores are put together from so many classes at a time.
STEP = 128
# Rows of posts that a task scores together, and gains that it adds up at once.
ROWS, ENTRIES = 1 << 17, 1 << 21
# Bytes of input for each bucket of terms that is summed up at once.
TEXT_BYTES = 4 << 20
# Tokens of rare terms that a task holds before it hands them on.
TOKENS = 1 << 18
# Posts that follow each other are scored together by so many bits of their numbers.
PART_BITS = 14
RARE, GAINS = range(2)


def class_term_counts(posts: DataFrame, tags: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(term, df, seen)`` over the (post, tag) rows, in one pass over the texts.

    ``seen`` lists the classes in which the term was seen with its count there; ``df`` counts rows. Counts are whole numbers,
    summed by (term, class) in the tasks before anything is shuffled. The null term counts rows.
    """
    given = filled(posts.select("Id", "Body"))
    buckets = min(max(given_bytes(given) // TEXT_BYTES, 16), 1 << 13)
    return class_lists(labelled_posts(given, tags, vocab), "classes", buckets)


def class_counts(labelled: DataFrame, rows_of: Callable[..., DataFrame]) -> DataFrame:
    """As ``class_term_counts``, from posts with their ``classes``; ``rows_of`` gives a post's ``(term, tf)`` rows."""
    rows = rows_of(labelled, "classes").withColumn("class", F.explode_outer("classes"))
    tf = F.coalesce("tf", F.lit(1)) * F.col("class.n")
    by_class = rows.groupBy("term", F.col("class.CatId").alias("place")).agg(
        F.sum("class.n").alias("df"), F.sum(tf).alias("n")
    )
    return by_term(by_class)


def by_term(by_class: DataFrame) -> DataFrame:
    """``(term, df, seen)`` from ``(term, place, df, n)``, one row per term and class."""
    seen = F.collect_list(F.struct("place", "n")).cast(SEEN)
    return by_class.groupBy("term").agg(F.sum("df").alias("df"), seen.alias("seen"))


def term_bytes() -> Column:
    """What a row of a model's term table takes up besides the term."""
    return F.lit(ROW_OVERHEAD) + 24 * F.size("seen")


def with_gains(rows: DataFrame, smoothing: float) -> DataFrame:
    """``(term, df, idf, gains)`` of a term table: what a class in which a term was seen gains by its weight of one."""
    gain = lambda c: F.struct(c["place"].alias("place"), F.ln((F.col("idf") * c["n"] + smoothing) / smoothing).alias("g"))
    return rows.select("term", "df", "idf", F.transform("seen", gain).alias("gains"))


def _doubles(values: list[float]) -> Column:
    """A constant array, as one text that Spark reads once, however many values there are."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


@dataclass(frozen=True)
class BayesModel:
    """A fitted model: a term table on the cluster, and a few numbers per class.

    ``terms`` has ``(term, df, idf, seen)``, where ``seen`` lists the counts of the classes in which the term was
    seen. ``places`` has the numbers by which the lists name the classes.

    With ``slots`` the terms are the numbers of so many hashed slots, as texts. Then every slot is a term of the model,
    and one without a training row has a weight too, as in MLlib.
    """

    terms: TermTable
    places: list[int]
    class_ids: list[int]
    tags: list[str]
    class_rows: list[int]
    class_weights: list[float]
    smoothing: float
    slots: int = 0

    def rows_of(self, posts: DataFrame, *keep: str) -> DataFrame:
        """One row ``(*keep, term, tf)`` for each distinct term of each post, and one with a null term per post."""
        return slot_rows(posts, *keep, slots=self.slots) if self.slots else term_rows(posts, *keep)

    @property
    def log_priors(self) -> list[float]:
        total = sum(self.class_rows) + len(self.class_rows) * self.smoothing
        return [math.log(n + self.smoothing) - math.log(total) for n in self.class_rows]

    @property
    def log_totals(self) -> list[float]:
        """What a class's log likelihoods are divided by, as a logarithm."""
        unseen = (self.slots or self.terms.n_terms) * self.smoothing
        return [math.log(weight + unseen) for weight in self.class_weights]

    def classes(self) -> DataFrame:
        """``(place, CatId, tags, log_total)``."""
        rows = list(zip(self.places, self.class_ids, self.tags, self.log_totals))
        return class_table(rows, self.terms.rows.sparkSession, "place INT, CatId INT, tags STRING, log_total DOUBLE")

    def log_likelihoods(self) -> DataFrame:
        """``(term, CatId, weight, log_likelihood)`` for each term and class that were seen together.

        A row with a null term has what a class gives each of the terms that it lacks.
        """
        counts = self.terms.rows.select("term", "idf", F.explode_outer("seen").alias("c"))
        weight = F.col("idf") * F.col("c.n")
        seen = counts.select("term", weight.alias("weight"), F.col("c.place").alias("place"))
        classes = self.classes()
        lacking = classes.select(F.lit(None).cast("string").alias("term"), F.lit(0.0).alias("weight"), "place")
        return seen.unionByName(lacking).join(classes, "place").select(
            "term",
            "CatId",
            "weight",
            (F.ln(F.col("weight") + self.smoothing) - F.col("log_total")).alias("log_likelihood"),
        )

    def kept_in_place(self, max_bytes: int = BROADCAST_BYTES // 2) -> DataFrame:
        """The rows of the most frequent terms, as many as take ``max_bytes``, for ``only``: most tokens are theirs."""
        return self.terms.rows.where(F.col("df") >= self.terms.hot_df(max_bytes))

    def only(self, posts: DataFrame, in_place: DataFrame | None = None) -> "BayesModel":
        """This model with the terms of ``posts`` only, written: it gives them the same scores.

        Terms of ``in_place``, a bounded part of the table, are not looked up again. The others are looked up in the
        buckets that they fall into.
        """
        return self.only_of(self.rows_of(filled(posts.select("Body"), "Body")), in_place)

    def only_of(self, rows: DataFrame, in_place: DataFrame | None = None) -> "BayesModel":
        """As ``only``, for posts given as their ``rows_of``."""
        tokens = rows.where("term IS NOT NULL").select("term").distinct()
        if in_place is not None:
            tokens = tokens.join(F.broadcast(in_place.select("term")), "term", "left_anti")
        found = self.terms.of_terms(written(tokens, "wanted-terms"))
        if in_place is not None:
            found = found.unionByName(in_place)
        part = TermTable.measure(written(found, "found-terms"), term_bytes())
        # the scores depend on the number of all terms
        return replace(self, terms=replace(part, n_terms=self.terms.n_terms))

    def scores(self, posts: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
        """``(Id, scores)``: for each post the joint log likelihood of the class at each place, -Infinity for none.

        A class's score is its prior, plus what all weight of the post would get for unseen terms,
        plus a gain for each term seen in the class. Only the gains need the term table, and only classes
        that share a term with the post have any. Posts without a known term keep the prior. ``Id`` must be unique.
        """
        return self.scores_of(self.rows_of(filled(posts, "Body"), "Id"), max_broadcast)

    def scores_of(self, post_rows: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
        """As ``scores``, for posts given as their ``rows_of``, which is read twice if the table is not broadcast."""
        table = replace(self.terms, rows=with_gains(self.terms.rows, self.smoothing))
        hot, whole = table.hot(max_broadcast), table.n_bytes <= max_broadcast
        unknown = math.log(sum(self.class_rows) + 1) if self.slots else None
        parts = gain_sums(post_rows, hot, unknown if whole else None)
        if not whole:
            idf = F.col("idf") if unknown is None else F.coalesce("idf", F.lit(unknown))
            rare = table.attach_rare(post_rows, hot).select("Id", (F.col("tf") * idf).alias("x"), F.posexplode_outer("gains").alias("at", "c"))
            # the weight of a term counts once, whatever the number of its classes
            once = F.when(F.coalesce("at", F.lit(0)) == 0, F.col("x")).alias("x")
            parts = parts.unionByName(rare.select("Id", F.col("c.place").alias("place"), once, (F.col("x") * F.col("c.g")).alias("g")))
        by_class = parts.groupBy("Id", "place").agg(F.sum("x").alias("x"), F.sum("g").alias("g"))
        seen = F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "g")))
        return self._scores(by_class.groupBy("Id").agg(F.coalesce(F.sum("x"), F.lit(0.0)).alias("x"), seen.alias("seen")))

    def _scores(self, sums: DataFrame) -> DataFrame:
        """``(Id, scores)`` from the weight ``x`` of each post and its gains, listed in ``seen``."""
        lam = self.smoothing
        n_places = max(self.places) + 1
        priors, unseen = [-math.inf] * n_places, [0.0] * n_places
        for place, prior, total in zip(self.places, self.log_priors, self.log_totals):
            priors[place], unseen[place] = prior, math.log(lam) - total
        base = F.zip_with(_doubles(priors), _doubles(unseen), lambda prior, share: prior + F.col("x") * share)
        # the gains by steps of classes, so that a lookup goes through few of them
        step_of = lambda step: F.map_from_entries(F.filter("seen", lambda c: F.floor(c["place"] / STEP) == step))
        steps = F.transform(F.sequence(F.lit(0), F.lit((n_places - 1) // STEP)), step_of)
        gained = sums.select("Id", base.alias("base"), steps.alias("steps"))

        def scores_of(gains: Column, step: Column) -> Column:
            found = lambda at: F.coalesce(F.try_element_at(gains, step * STEP + at), F.lit(0.0))
            return F.transform(F.slice("base", step * STEP + 1, STEP), lambda value, at: value + found(at))

        return gained.select("Id", F.flatten(F.transform("steps", scores_of)).alias("scores"))

    def predict(self, posts: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
        """``(Id, CatId, tags, confidence)``; of equal scores the lowest class wins."""
        return self.predict_of(self.rows_of(filled(posts, "Body"), "Id"), max_broadcast)

    def predict_of(self, post_rows: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
        """As ``predict``, for posts given as their ``rows_of``."""
        chosen = self.chosen(self.scores_of(post_rows, max_broadcast))
        return chosen.join(self.classes(), "place").select("Id", "CatId", "tags", "confidence")

    def chosen(self, scores: DataFrame) -> DataFrame:
        """``(Id, place, confidence)``: the best class of each post, by its place."""
        scored = scores.withColumn("best", F.array_max("scores"))
        return scored.select(
            "Id",
            (F.array_position("scores", F.col("best")) - 1).cast("int").alias("place"),
            (1 / _total(F.transform("scores", lambda s: F.exp(s - F.col("best"))))).alias("confidence"),
        )

    def looked_up(self, rows: DataFrame, in_place: DataFrame, max_bytes: int = BROADCAST_BYTES // 2) -> DataFrame:
        """``(Id, scores)`` as ``scores_of`` for ``rows_of`` posts that have whole numbers as ``Id``; in a ``temporary`` block.

        The texts are split once. Tokens of the terms ``in_place`` (those of ``kept_in_place(max_bytes)``) are added up there;
        the others are written packed by the bucket of their term, meet the rows of the term table in it, and go
        back to their posts as counts. So no row of Spark is made, shuffled or written for a token.
        """
        buckets = self.terms.buckets or 1 + self.terms.n_bytes // TEXT_BYTES
        cut = self.terms.hot_df(max_bytes)
        packed = written(_matched(rows, in_place, self.smoothing, buckets), "batch-terms")
        tokens = packed.where(F.col("kind") == RARE).select(F.col("at").alias("bucket"), "data")
        table = self.terms.rows.where(F.col("df") < cut)
        if self.terms.buckets:
            hit = tokens.select("bucket").distinct().collect()
            table = table.where(F.col("bucket").isin([row["bucket"] for row in hit]))
        table = table.select(
            term_bucket(F.col("term"), buckets).cast("bigint").alias("bucket"),
            "term",
            "idf",
            F.col("seen.place").alias("place"),
            F.col("seen.n").alias("n"),
        )
        found = tokens.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(_found, PACKED)
        parts = packed.where(F.col("kind") == GAINS).unionByName(found).groupBy("at")
        sums = f"Id {rows.schema['Id'].dataType.simpleString()}, x DOUBLE, seen ARRAY<STRUCT<place:INT,g:DOUBLE>>"
        return self._scores(parts.applyInArrow(_summed(self.smoothing), sums))

    def score_rows(self, posts: DataFrame) -> DataFrame:
        """``(Id, CatId, tags, score, probability)`` for each post and class."""
        scored = self.scores(posts).withColumn("best", F.array_max("scores"))
        scored = scored.withColumn("total", _total(F.transform("scores", lambda s: F.exp(s - F.col("best")))))
        rows = scored.select("Id", "best", "total", F.posexplode_outer("scores").alias("place", "score"))
        return rows.join(self.classes(), "place").select(
            "Id",
            "CatId",
            "tags",
            "score",
            (F.exp(F.col("score") - F.col("best")) / F.col("total")).alias("probability"),
        )


@dataclass(frozen=True)
class Held:
    """Frequent terms as columns, for the Python workers: ``size`` classes a term, one term after the other."""

    terms: pa.Array
    idf: np.ndarray
    size: np.ndarray
    place: np.ndarray
    gain: np.ndarray

    @classmethod
    def of(cls, hot: DataFrame) -> "Held":
        """From rows (term, idf, gains), few enough to be sent."""
        held = hot.select("term", "idf", F.col("gains.place").alias("place"), F.col("gains.g").alias("g")).toArrow().combine_chunks()
        column = lambda name: held[name].combine_chunks() if isinstance(held[name], pa.ChunkedArray) else held[name]
        flat = lambda name: pc.list_flatten(column(name)).to_numpy(zero_copy_only=False)
        size = pc.fill_null(pc.list_value_length(column("place")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        return cls(column("term"), column("idf").to_numpy(zero_copy_only=False), size, flat("place"), flat("g"))

    @property
    def n_places(self) -> int:
        return int(self.place.max(initial=0)) + 1

    def at(self, known: pa.Array) -> np.ndarray:
        """The place of each term here, -1 for none."""
        return pc.fill_null(pc.index_in(known, value_set=self.terms, skip_nulls=True), -1).to_numpy()

    def gains(self, post: np.ndarray, at: np.ndarray, weight: np.ndarray, n_posts: int) -> Iterator[tuple[np.ndarray, ...]]:
        """``(post, place, g)``, some entries at a time, of the terms ``at`` that posts have with a ``weight``."""
        start = np.cumsum(self.size) - self.size
        before = np.cumsum(self.size[at])
        steps = np.searchsorted(before, np.arange(ENTRIES, before[-1], ENTRIES)) if len(before) else []
        for some in np.split(np.arange(len(at)), steps):
            n_met = self.size[at[some]]
            row = np.repeat(some, n_met)
            if not len(row):
                continue
            entry = ranges(start[at[some]], n_met)
            pair = post[row] * self.n_places + self.place[entry]
            of_pair = np.arange(n_posts * self.n_places) if n_posts * self.n_places <= 8 * len(pair) else None
            if of_pair is None:
                of_pair, pair = np.unique(pair, return_inverse=True)
            g = np.bincount(pair, weights=weight[row] * self.gain[entry], minlength=len(of_pair))
            seen = np.flatnonzero(g)
            of_pair = of_pair[seen]
            yield of_pair // self.n_places, of_pair % self.n_places, g[seen]


def gain_sums(post_rows: DataFrame, hot: DataFrame, unknown: float | None) -> DataFrame:
    """``(Id, place, x, g)``: sums of the weights and gains that posts get from the terms of ``hot``, in any number of parts.

    ``hot`` (term, idf, gains), a table small enough to be broadcast, goes to the Python workers as columns. The rows
    with a null place have the weights, for every post at least one; terms that ``hot`` lacks weigh as ``unknown``, if given.
    """
    spark = post_rows.sparkSession
    ship(spark)
    shared = send(spark, Held.of(hot))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for rows in _joined(batches):
            ids = rows.column(0).dictionary_encode("encode")
            post = ids.indices.to_numpy().astype(np.int64)
            n_posts = len(ids.dictionary)
            words = rows.column(1).dictionary_encode("encode")
            at = held.at(words.dictionary)[words.indices.to_numpy()]
            tf = pc.fill_null(rows.column(2), 0).to_numpy()
            found = at >= 0
            weight = np.where(found, tf * held.idf[at], 0.0 if unknown is None else tf * unknown) if len(held.idf) else tf * (unknown or 0.0)
            sums = np.bincount(post, weights=weight, minlength=n_posts)
            yield _parts(ids.dictionary, pa.nulls(n_posts, pa.int32()), pa.array(sums), pa.nulls(n_posts, pa.float64()))
            for of, place, g in held.gains(post[found], at[found], weight[found], n_posts):
                places, none = pa.array(place.astype(np.int32)), pa.nulls(len(of), pa.float64())
                yield _parts(ids.dictionary.take(pa.array(of)), places, none, pa.array(g))

    schema = StructType([post_rows.schema["Id"], *StructType.fromDDL("place INT, x DOUBLE, g DOUBLE").fields])
    return post_rows.select("Id", "term", "tf").mapInArrow(work, schema)


PACKED = "kind INT, at BIGINT, data BINARY"


def _packed(kind: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    at, data = zip(*rows) if rows else ((), ())
    columns = [pa.array([kind] * len(rows), pa.int32()), pa.array(at, pa.int64()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "at", "data"])


def _matched(rows: DataFrame, in_place: DataFrame, smoothing: float, buckets: int) -> DataFrame:
    """The posts behind ``rows`` packed: gains of the terms ``in_place`` by parts of posts, other tokens by buckets of terms.

    Every post is among the gains, with its weight so far.
    """
    spark = rows.sparkSession
    ship(spark)
    shared = send(spark, Held.of(with_gains(in_place, smoothing)))

    def work(blocks: Iterator[Postings]) -> Iterator[pa.RecordBatch]:
        lean()
        held, rare = shared.value, []
        for ids, post, term, tf, known in blocks:
            ids = ids.to_numpy().astype(np.int64)
            of_term = held.at(known)
            at = of_term[term]
            found = at >= 0
            tokens = np.flatnonzero(~found)
            if len(tokens):
                wanted, own = np.unique(term[tokens], return_inverse=True)
                rare.append((known.take(pa.array(wanted)), own, ids[post[tokens]], tf[tokens]))
                if sum(len(some[1]) for some in rare) >= TOKENS:
                    yield _packed(RARE, list(_dealt(rare, buckets)))
                    rare = []
            post, at = post[found], at[found]
            weight = tf[found] * held.idf[at]
            x = np.bincount(post, weights=weight, minlength=len(ids))
            of, place, g = added_up(list(held.gains(post, at, weight, len(ids))))
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(ids)))])
            # posts of a block have numbers that follow each other, but for a change of files
            edges = [0, *(np.flatnonzero(np.diff(ids >> PART_BITS)) + 1), len(ids)] if len(ids) else [0]
            parts = [(int(ids[a]) >> PART_BITS, slice(a, b), slice(ends[a], ends[b])) for a, b in zip(edges[:-1], edges[1:])]
            low = ids & ((1 << PART_BITS) - 1)
            yield _packed(GAINS, [
                (part, pack(low[some], x[some], low[of[inside]], place[inside], g[inside])) for part, some, inside in parts
            ])
        if rare:
            yield _packed(RARE, list(_dealt(rare, buckets)))
        lean()

    return over_postings(rows, work, PACKED)


def _dealt(rare: list[tuple], buckets: int) -> Iterator[tuple[int, bytes]]:
    """Tokens ``(terms, place in them, post, tf)`` of some blocks, by the bucket of their term."""
    found = pa.concat_arrays([terms for terms, *_ in rare]).dictionary_encode()
    first = np.cumsum([0, *(len(terms) for terms, *_ in rare)])
    of_term = found.indices.to_numpy().astype(np.int64)
    term = np.concatenate([of_term[own + at] for at, (_, own, _, _) in zip(first, rare)])
    post, tf = (np.concatenate([some[at] for some in rare]) for at in (2, 3))
    bucket = buckets_of(found.dictionary, buckets)
    order = np.argsort(bucket, kind="stable")  # of the terms
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    term = place[term]
    by_term = np.argsort(term, kind="stable")
    term, post, tf = term[by_term], post[by_term], tf[by_term]
    terms = found.dictionary.take(pa.array(order))
    times = np.bincount(term, minlength=len(order))
    ends = np.concatenate([[0], np.cumsum(times)])
    for at, some in cuts(bucket[order]):
        inside = slice(ends[some.start], ends[some.stop])
        low = int(post[inside].min())
        part = terms.slice(some.start, some.stop - some.start)
        yield at, pack(np.array([low]), part, times[some], post[inside] - low, tf[inside])


def _found(tokens: pa.Table, table: pa.Table) -> pa.Table:
    """What the tokens of a bucket get from the term table: ``(post, tf, idf, classes with counts)``, by parts of posts."""
    given = [unpack(data.as_py()) for data in tokens.column("data")]
    schema = pa.schema([("kind", pa.int32()), ("at", pa.int64()), ("data", pa.binary())])
    if not given or not table.num_rows:
        return schema.empty_table()
    table = table.combine_chunks()
    column = lambda name: table[name].combine_chunks() if isinstance(table[name], pa.ChunkedArray) else table[name]
    size = pc.fill_null(pc.list_value_length(column("place")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size) - size
    places, counts = (pc.list_flatten(column(name)).to_numpy(zero_copy_only=False) for name in ("place", "n"))
    idf = column("idf").to_numpy(zero_copy_only=False)
    terms = pa.concat_arrays([terms for _, terms, *_ in given])
    of_term = pc.fill_null(pc.index_in(terms, value_set=column("term")), -1).to_numpy()
    at = np.repeat(of_term, np.concatenate([times for _, _, times, *_ in given]))
    post = np.concatenate([low[0] + post for low, _, _, post, _ in given])
    tf = np.concatenate([tf for *_, tf in given])
    known = np.flatnonzero(at >= 0)
    known = known[np.argsort(post[known], kind="stable")]
    at, post, tf = at[known], post[known], tf[known]
    low = post & ((1 << PART_BITS) - 1)
    rows = []
    for part, some in cuts(post >> PART_BITS):
        entry = ranges(start[at[some]], size[at[some]])
        rows.append((part, pack(low[some], tf[some], idf[at[some]], size[at[some]], places[entry], counts[entry])))
    return pa.Table.from_batches([_packed(GAINS, rows)], schema)


def _summed(smoothing: float) -> Callable[[pa.Table], pa.Table]:
    """``(Id, x, seen)`` of a part of the posts, from their gains in place and what their other tokens got."""

    def work(table: pa.Table) -> pa.Table:
        lean()
        part, x, met = table["at"][0].as_py() << PART_BITS, np.zeros(1 << PART_BITS), np.zeros(1 << PART_BITS, bool)
        held: list[tuple[np.ndarray, ...]] = []
        for data in table["data"]:
            columns = unpack(data.as_py())
            if len(columns) == 5:
                every, weight, own, places, gains = columns
                met[every] = True
            else:
                every, tf, idf, size, places, counts = columns
                weight, own = tf * idf, np.repeat(every, size)
                gains = np.repeat(weight, size) * np.log((np.repeat(idf, size) * counts + smoothing) / smoothing)
            x += np.bincount(every, weights=weight, minlength=len(x))
            held.append((own, places, gains))
            if sum(len(some[0]) for some in held) >= ENTRIES // 4:
                held = [added_up(held)]
        of, place, g = added_up(held)
        ids = np.flatnonzero(met)
        ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(x))[ids])]).astype(np.int32)
        entries = pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(g)], ["place", "g"])
        seen = pa.ListArray.from_arrays(pa.array(ends), entries)
        summed = pa.Table.from_arrays([pa.array(part + ids), pa.array(x[ids]), seen], names=["Id", "x", "seen"])
        lean()
        return summed

    return work


def _parts(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=["Id", "place", "x", "g"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task, several put together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(part.num_rows for part in held) >= ROWS:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def fit_bayes(posts: DataFrame, tags: DataFrame, vocab: DataFrame, smoothing: float = SMOOTHING) -> BayesModel:
    """Fit on all rows of ``posts`` that have a tag of the vocabulary.

    Classes without a training row are left out, as a classifier never sees them.
    """
    if smoothing <= 0:
        raise ValueError("smoothing must be positive")
    classes = class_list(vocab)
    places = class_table([(at, tag) for at, (_, tag) in enumerate(classes)], posts.sparkSession)
    kept = new_folder(posts.sparkSession, "class-terms")
    with temporary(posts.sparkSession):
        table = written(class_term_counts(posts, tags, places), "class-terms", kept)
    return model_of(table, classes, smoothing)


def fit_slots(
    posts: DataFrame, tags: DataFrame, vocab: DataFrame, slots: int = HASH_SLOTS, smoothing: float = SMOOTHING
) -> BayesModel:
    """As ``fit_bayes`` over hashed slots: what MLlib's hashed model gives, for any number of classes.

    Only pairs of slot and class that were seen are kept, on the cluster, so nothing is dense in their product.
    """
    if smoothing <= 0:
        raise ValueError("smoothing must be positive")
    classes = class_list(vocab)
    places = class_table([(at, tag) for at, (_, tag) in enumerate(classes)], posts.sparkSession)
    kept = new_folder(posts.sparkSession, "class-slots")
    with temporary(posts.sparkSession):
        labelled = labelled_posts(filled(posts.select("Id", "Body")), tags, places)
        rows_of = lambda df, *keep: slot_rows(df, *keep, slots=slots)
        table = written(class_counts(labelled, rows_of), "class-slots", kept)
    return replace(model_of(table, classes, smoothing), slots=slots)


def model_of(table: DataFrame, classes: list[tuple[int, str]], smoothing: float = SMOOTHING) -> BayesModel:
    """The model of counts ``(term, df, seen)``, a written table, whose places are those of ``classes`` (class id, tag).

    The null term's counts are the numbers of rows. Classes without any are left out.
    """
    if smoothing <= 0:
        raise ValueError("smoothing must be positive")
    all_rows = table.where("term IS NULL").first()
    if not all_rows:
        raise ValueError("no post has a tag of the vocabulary")
    idf = inverse_frequency(F.lit(all_rows["df"]), F.col("df"))
    terms = table.where("term IS NOT NULL").select("term", "df", idf.alias("idf"), "seen")
    counts = table.select("term", idf.alias("idf"), F.explode_outer("seen").alias("c"))
    known = F.col("term").isNotNull()
    sums = counts.groupBy(F.col("c.place").alias("place")).agg(
        F.sum(F.when(~known, F.col("c.n"))).alias("n_rows"),
        F.coalesce(F.sum(F.when(known, F.col("idf") * F.col("c.n"))), F.lit(0.0)).alias("weight"),
    )
    # One row per class that was seen, as a model has a few numbers for each.
    seen = sums.orderBy("place").collect()
    return BayesModel(
        terms=TermTable.measure(terms, term_bytes()),
        places=[row["place"] for row in seen],
        class_ids=[classes[row["place"]][0] for row in seen],
        tags=[classes[row["place"]][1] for row in seen],
        class_rows=[row["n_rows"] for row in seen],
        class_weights=[row["weight"] for row in seen],
        smoothing=smoothing,
    )


def class_priors(posts: DataFrame, tags: DataFrame, vocab: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """``(CatId, Tag, n_rows, log_prior)`` of the classes that have training rows."""
    rows = with_class(filled(tags), vocab).join(filled(posts).select("Id"), "Id")
    counts = rows.groupBy(F.col("CatId").cast("int").alias("CatId"), "Tag").agg(F.count("*").alias("n_rows"))
    counts = written(counts, "class-counts")
    rows, classes = counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.count("*")).first()
    total = F.lit(rows + smoothing * classes)
    return counts.withColumn("log_prior", F.ln(F.col("n_rows") + smoothing) - F.ln(total))
