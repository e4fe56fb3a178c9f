"""Language identification by Bloom filters that hold the languages of each n-gram as bits."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagwright.llm.common import leanly, remainder, ship, texts, widened, without
from tagwright.session import written

UNKNOWN = "und"
LEAST_POSITIONS = 1 << 20  # of the filter: 8 bytes for each and every 64 languages
MOST_POSITIONS = 1 << 23  # 64 MB for every 64 languages
POSITIONS_PER_GRAM = 8
PROBES = 3
LEAST_COUNT = 2  # of an n-gram in a language
LEAST_SHARE = 0.2  # of the n-gram's frequency in the language where it is most frequent
AT_ONCE = 1 << 20  # characters worked on together
HELD_COUNTS = 1 << 20  # distinct n-grams a task holds before it hands them on
LOW, HIGH = 0.01, 0.99  # quantiles of the scores of labelled documents under their own and the best other language
SCORE_STEPS = 1000  # in which these scores are counted


@cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter or a mark on one."""
    kinds = (unicodedata.category(chr(point))[0] for point in range(0x110000))
    return np.fromiter((kind in "LM" for kind in kinds), bool, 0x110000)


def grams(docs: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Three-letter windows of the lower-cased texts as ``(codes, number of the text)``, in blocks of bounded size.

    All that is no letter reads as a word boundary, and so do both ends of a text. A window has a letter in
    its middle. A text longer than a block is cut into overlapping pieces, so each window is found once.
    """
    pieces: list[str] = []
    owners: list[int] = []
    held = 0
    for number, text in enumerate(docs):
        padded = f"\0{text.lower()}\0"
        for at in range(0, len(padded) - 2, AT_ONCE):
            piece = padded[at : at + AT_ONCE + 2]
            if held and held + len(piece) > AT_ONCE:
                yield _windows(pieces, owners)
                pieces, owners, held = [], [], 0
            pieces.append(piece)
            owners.append(number)
            held += len(piece)
    if pieces:
        yield _windows(pieces, owners)


def _windows(pieces: list[str], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, 0).astype(np.uint64)
    lengths = np.array(list(map(len, pieces)))
    owner = np.repeat(owners, lengths)[1:-1]
    middle = points[1:-1]
    inside = middle != 0
    ends = np.cumsum(lengths)[:-1]
    inside[ends - 1] = False  # the middle is the first or last of a piece
    inside[ends - 2] = False
    codes = (points[:-2] << np.uint64(42)) | (middle << np.uint64(21)) | points[2:]
    return codes[inside], owner[inside]


def lettered(docs: list[str]) -> np.ndarray:
    """Whether a text has a letter; marks alone are none."""
    return np.fromiter((any(map(str.isalpha, text)) for text in docs), bool, len(docs))


def probes(codes: np.ndarray, positions: int) -> np.ndarray:
    """The places of each code in the filter, one row per probe."""
    with np.errstate(over="ignore"):
        x = codes * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        step = (x >> np.uint64(33)) | np.uint64(1)
        return np.stack([(x + np.uint64(k) * step) % np.uint64(positions) for k in range(PROBES)])


@dataclass(frozen=True)
class LanguageFilter:
    """``table[plane, position]``: a bit for each language of the plane; ``false_hits``: chance of one, by language."""

    languages: tuple[str, ...]
    table: np.ndarray
    false_hits: np.ndarray

    def languages_of(self, codes: np.ndarray, plane: int) -> np.ndarray:
        """The bits of all languages of the plane that contain each n-gram."""
        first, *others = probes(codes, self.table.shape[1])
        found = self.table[plane][first]
        for place in others:
            found &= self.table[plane][place]
        return found

    def hits(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the n-grams each language contains, corrected for false positives, and the number of n-grams."""
        counted = np.zeros((len(docs), len(self.languages)))
        total = np.zeros(len(docs))
        for codes, owner in grams(docs):
            total += np.bincount(owner, minlength=len(docs))
            for number in range(len(self.languages)):
                if number % 64 == 0:
                    found = self.languages_of(codes, number // 64)
                has = (found >> np.uint64(number % 64)) & np.uint64(1)
                counted[:, number] += np.bincount(owner, weights=has, minlength=len(docs))
        expected = total[:, None] * self.false_hits
        return np.maximum(0.0, counted - expected) / (1 - self.false_hits), total


def gram_counts(labelled: DataFrame, label: str, text: str) -> DataFrame:
    """``(label, gram, n)`` over all given rows; each task sums before anything is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            by_label: dict[str, list[str]] = {}
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_label.setdefault(name, []).append(content)
            for name, contents in by_label.items():
                for codes, _ in grams(contents):
                    held[name] = _summed(held.get(name), *np.unique(codes, return_counts=True))
                    if len(held[name][0]) > HELD_COUNTS:
                        yield rows(name, *held.pop(name))
        for name, (codes, n) in held.items():
            yield rows(name, codes, n)

    def rows(name: str, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([name]).take(pa.array(np.zeros(len(codes), np.int64))), codes.view(np.int64), n]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["label", "gram", "n"])

    source = labelled.select(F.col(label).alias("label"), F.col(text).alias("text"))
    found = source.mapInArrow(leanly(work), "label string, gram long, n long")
    return found.groupBy("label", "gram").agg(F.sum("n").alias("n"))


def _summed(held, codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if held is None:
        return codes, n
    both, weights = np.concatenate([held[0], codes]), np.concatenate([held[1], n])
    distinct, place = np.unique(both, return_inverse=True)
    return distinct, np.bincount(place, weights=weights, minlength=len(distinct)).astype(np.int64)


def fit_languages(
    labelled: DataFrame, label: str = "lang", text: str = "text", positions: int | None = None
) -> LanguageFilter:
    """The filter of all n-grams of the labelled texts.

    A language contains an n-gram if it has it ``LEAST_COUNT`` times and its frequency there is at least
    ``LEAST_SHARE`` of that in the language where it is most frequent. All counts are taken over all rows.
    What reaches the driver is the filter: ``positions`` numbers per 64 languages. By default there are eight
    for each n-gram that is held, up to 64 MB; the expected false hits are taken off the counts in any case.
    """
    ship(labelled.sparkSession)
    source = texts(labelled.where(F.col(label).isNotNull()), label, text=text)
    counts = written(gram_counts(source, label, text), "language-grams")
    totals = counts.groupBy("label").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "label").collect()
    languages = tuple(row["label"] for row in totals)
    planes = max(1, -(-len(languages) // 64))
    table = np.zeros((planes, positions or LEAST_POSITIONS), np.uint64)
    if languages:
        numbers = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
        sums = F.create_map(*[F.lit(x) for row in totals for x in (row["label"], float(row["total"]))])
        known = counts.where(F.col("n") >= LEAST_COUNT).select(
            "gram", numbers[F.col("label")].alias("number"), (F.col("n") / sums[F.col("label")]).alias("share")
        )
        # at most one row per language for a gram
        top = F.max("share").over(Window.partitionBy("gram"))
        held = known.withColumn("top", top).where(F.col("share") >= LEAST_SHARE * F.col("top"))
        bits = held.select(
            "gram",
            F.expr("number div 64").cast("int").alias("plane"),
            F.expr("shiftleft(1L, CAST(number % 64 AS INT))").alias("bit"),
        )
        masks = written(bits.groupBy("gram", "plane").agg(F.bit_or("bit").alias("mask")), "language-masks")
        if positions is None:
            wanted = POSITIONS_PER_GRAM * masks.count()
            positions = min(MOST_POSITIONS, max(LEAST_POSITIONS, 1 << (wanted - 1).bit_length()))
            table = np.zeros((planes, positions), np.uint64)

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                for place in probes(codes, positions):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place.astype(np.int64)), batch.column(1), batch.column(2)],
                        names=["place", "plane", "mask"],
                    )

        placed = masks.select("gram", "plane", "mask").mapInArrow(leanly(places), "place long, plane int, mask long")
        slices = placed.groupBy("place", "plane").agg(F.bit_or("mask").alias("mask")).toArrow()
        plane, place = slices["plane"].to_numpy(), slices["place"].to_numpy()
        table[plane, place] = slices["mask"].to_numpy().view(np.uint64)
    set_share = [
        ((table[number // 64] >> np.uint64(number % 64)) & np.uint64(1)).mean() for number in range(len(languages))
    ]
    return LanguageFilter(languages, table, np.minimum(np.array(set_share) ** PROBES, 0.999))


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the text's n-grams that the language contains.

    The language with most n-grams, after the correction for false positives, is predicted; of equal ones that with
    more training text. A null text, or one without a letter, is ``und`` with score 0; so is every text if
    nothing was learned. Whole texts are read. Columns of the input named like an added one are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    given = without(docs, "lang_pred", "score")
    at = given.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array([*own.languages, UNKNOWN], object)
        for batch in batches:
            contents = [content or "" for content in batch.column(at).to_pylist()]
            counted, total = own.hits(contents)
            if own.languages:
                has = lettered(contents)
                best = np.where(has, counted.argmax(axis=1), len(own.languages))
                score = np.where(has, counted.max(axis=1) / np.maximum(total, 1), 0.0)
            else:
                best, score = np.zeros(len(contents), np.int64), np.zeros(len(contents))
            added = [pa.array(names[best], pa.string()), pa.array(np.clip(score, 0.0, 1.0))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, "lang_pred", "score"]
            )

    return given.mapInArrow(leanly(work), widened(given.schema, lang_pred="string", score="double"))


def held_out(key: Column) -> Column:
    return remainder(key, 4) == 2


def learned(docs: DataFrame) -> LanguageFilter:
    """The filter learned from the documents that are not held out."""
    return fit_languages(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))


def document_languages(docs: DataFrame) -> DataFrame:
    found = identify(texts(docs, "doc_id"), learned(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def score_counts(labelled: DataFrame, model: LanguageFilter, label: str = "lang", text: str = "text") -> DataFrame:
    """``(language, step, n)``: how many labelled texts have which score, in steps of one in ``SCORE_STEPS``.

    ``language`` is the number of their own one, under which the score is; -1 has the scores of the same texts under the
    best of the other languages. Texts without letters, or with a label that ``model`` lacks, do not count.
    """
    spark = labelled.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {name: number for number, name in enumerate(shared.value.languages)}
        counts = np.zeros((len(numbers) + 1, SCORE_STEPS + 1), np.int64)  # the last row is that of -1
        for batch in batches:
            counted, total = shared.value.hits(batch.column(1).to_pylist())
            steps = np.floor(np.clip(counted / np.maximum(total, 1)[:, None], 0, 1) * SCORE_STEPS).astype(np.int64)
            own = np.array([numbers[name] for name in batch.column(0).to_pylist()], np.int64)
            has = np.flatnonzero(total > 0)
            np.add.at(counts, (own[has], steps[has, own[has]]), 1)
            steps[np.arange(len(own)), own] = 0
            np.add.at(counts, (-1, steps[has].max(axis=1)), 1)
        language, step = np.nonzero(counts)
        columns = [np.where(language == len(numbers), -1, language), step, counts[language, step]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["language", "step", "n"])

    taught = labelled.where(F.col(label).isin(*model.languages)).select(
        F.col(label).alias("label"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    found = taught.mapInArrow(leanly(work), "language long, step long, n long")
    return found.groupBy("language", "step").agg(F.sum("n").alias("n"))


def least_covers(labelled: DataFrame, model: LanguageFilter, label: str = "lang", text: str = "text") -> np.ndarray:
    """For each language the least score of a document that is taken to be in it.

    It lies halfway between the scores that labelled texts get under their own language (the quantile ``LOW`` of that
    language) and those they get under the best other one (``HIGH``, of all), as a text in a language that nobody
    taught does; but never above the former. All given texts count, which should be others than ``model``
    learned from. A language without any is given the lowest of the others.
    """
    counts = {number: np.zeros(SCORE_STEPS + 1, np.int64) for number in range(-1, len(model.languages))}
    for row in score_counts(labelled, model, label, text).collect():
        counts[row["language"]][row["step"]] = row["n"]
    quantile = lambda n, share: np.searchsorted(np.cumsum(n), max(1.0, share * n.sum())) / SCORE_STEPS if n.any() else np.nan
    other = np.nan_to_num(quantile(counts.pop(-1), HIGH))
    own = np.array([quantile(counts[number], LOW) for number in range(len(model.languages))])
    own = np.where(np.isnan(own), np.nanmin(own, initial=1.0), own)
    return np.minimum(own, (own + other) / 2)


def in_known_language(docs: DataFrame, least: float | None = None) -> DataFrame:
    """The documents whose text has letters and whose language contains enough of its n-grams.

    Without ``least``, a share for all languages, that is the share which ``least_covers`` finds on the held-out
    documents, less the standard deviation of a share of so few n-grams as the text has. All columns stay as
    they are, whatever their names. An empty table gives no rows; so does one without any label, as no language
    is known then.
    """
    spark = docs.sparkSession
    model = learned(docs)
    if not model.languages:
        return docs.limit(0)
    if least is None:
        covers = least_covers(docs.where(held_out(F.col("doc_id"))).select("lang", "text"), model)
    else:
        covers = np.full(len(model.languages), least)
    shared = spark.sparkContext.broadcast((model, covers))
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, covers = shared.value
        for batch in batches:
            contents = [content or "" for content in batch.column(at).to_pylist()]
            counted, total = own.hits(contents)
            score = np.clip(counted.max(axis=1) / np.maximum(total, 1), 0.0, 1.0)
            cover = covers[counted.argmax(axis=1)]
            if least is None:
                cover = cover - np.sqrt(cover * (1 - cover) / np.maximum(total, 1))
            yield batch.filter(pa.array(lettered(contents) & (score >= cover)))

    return docs.mapInArrow(leanly(work), docs.schema)
