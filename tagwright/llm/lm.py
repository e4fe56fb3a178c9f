"""Language-model scores from a log-frequency Bloom filter."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.blocks import (
    DOCUMENTS,
    HASHES,
    NGRAMS,
    WORDS,
    Block,
    batched,
    by_range,
    coded,
    numbers_and_counts,
    packed,
    row_of,
    segments_for,
    spans,
    squeezed,
    stored,
    stretched,
    unpacked,
    words_in,
)
from tagwright.llm.common import lean, remainder, ship, texts
from tagwright.session import delete, new_folder, written

END = b" "  # no word has a space
LOG_BASE = 1.5  # of the quantised counts
PROBES = 5
BITS_PER_ENTRY = 10  # about one false answer in a hundred for each level
LEAST_PAIRS = 2  # a pair of words is entered if it was seen as often
PAIR_SHARE = 0.3  # of the probability that comes from pairs
KEPT_BITS = 48  # of the hash of an n-gram
LEVELS = 80


def level_of(counts: np.ndarray) -> np.ndarray:
    """The quantised count: 1 for a single one, and one more for each factor of ``LOG_BASE``."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(LOG_BASE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The mean of the counts that share a level; 0 for level 0."""
    low = np.ceil(LOG_BASE ** (np.maximum(levels, 1) - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(LOG_BASE ** np.maximum(levels, 1) - 1e-9) - 1)
    return np.where(levels > 0, (low + high) / 2, 0.0)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def shortened(x: np.ndarray) -> np.ndarray:
    return mixed(x) >> np.uint64(64 - KEPT_BITS)


def single_keys(hashes: np.ndarray) -> np.ndarray:
    return shortened(hashes)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return shortened(mixed(first + np.uint64(1)) + second)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """The range of hashes, of a power of two of them, that a key lies in."""
    return keys >> np.uint64(KEPT_BITS - (segments.bit_length() - 1))


def entry_bits(keys: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    """For one probe after the other, the places of the entries ``(key, level)`` within their segment."""
    with np.errstate(over="ignore"):
        x = mixed(keys + np.uint64(level) * np.uint64(0xD6E8FEB86659FD93))
        step = (x >> np.uint64(32)) | np.uint64(1)
        for probe in range(PROBES):
            yield (x + np.uint64(probe) * step) % np.uint64(bits)


@dataclass(frozen=True)
class CountFilter:
    """Quantised counts of the n-grams of a range of hashes as entries ``(n-gram, 1) .. (n-gram, level)`` of a Bloom filter."""

    bits: int
    data: np.ndarray

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Probe level after level until one is not there; an n-gram that is not in the filter has level 0.

        A true level is never missed. A false answer adds one to it, for about one n-gram of a hundred.
        """
        found = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys)) if self.bits else np.empty(0, np.int64)
        for level in range(1, LEVELS):
            own = keys[alive]
            kept = np.arange(len(alive))
            for place in entry_bits(own, level, self.bits) if len(alive) else ():
                spot = place[kept]
                kept = kept[(self.data[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            alive = alive[kept]
            if not len(alive):
                break
            found[alive] = level
        return found


def build_filter(keys: np.ndarray, levels: np.ndarray) -> CountFilter:
    """The filter of all the given n-grams, as large as their entries need."""
    bits = 64 * -(-int(levels.sum()) * BITS_PER_ENTRY // 64)
    flags = np.zeros(bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for place in entry_bits(keys[levels >= level], level, bits):
            flags[place] = True
    return CountFilter(bits, np.packbits(flags, bitorder="little"))


@dataclass(frozen=True)
class Totals:
    """Tokens and distinct words of the training texts."""

    tokens: int
    distinct: int

    def single(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))


def log_probabilities(pairs: np.ndarray, first: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """log10 of the probability of each word after the word before it.

    ``pairs`` and ``first`` are the counts of the two words together and of the word before, and ``alone`` is the
    probability of each word by itself. A pair adds its share of the word before; a word that was never seen
    before another one leaves all to ``alone``.
    """
    share = np.minimum(1.0, pairs / np.maximum(first, 1.0))
    both = PAIR_SHARE * share + (1 - PAIR_SHARE) * alone
    return np.log10(np.where(first > 0, both, alone))


def ngram_rows(block: Block, segments: int) -> Iterator[pa.RecordBatch]:
    """Sorted hashes of the words and pairs of the block with their counts in training texts, a row per range of hashes.

    The lowest bit of a count tells pairs from single words. The n-grams of held-out texts alone have count 0.
    """
    end = np.array([block.words.index(END)], np.uint32)
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    parts = []
    held = [codes for codes, flag in zip(block.codes, block.flags) if not flag]
    for times, part in [*((1, part) for part in batched(block.flagged())), *((0, part) for part in batched(held))]:
        line = np.concatenate([end, *part])  # every text ends with END, which comes before the next one
        hashes = block.hashes[line] >> np.uint64(24)
        pairs, n = np.unique(pair_keys(hashes[:-1], hashes[1:]), return_counts=True)
        parts.append((pairs, n * (2 * times) + 1))
        singles, n = np.unique(single_keys(hashes[1:]), return_counts=True)
        parts.append((singles, n * (2 * times)))
        if len(parts) >= 8:
            keys, counts = summed([(keys, counts), *parts])
            parts = []
    keys, counts = summed([(keys, counts), *parts])
    part = segment_of(keys, segments).astype(np.int64)
    for start, stop in spans(part):
        yield row_of(
            NGRAMS,
            block.number,
            at=int(part[start]),
            data=packed_keys(keys[start:stop]),
            more=packed(counts[start:stop].astype(np.uint32)),
        )


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts; the lowest bit of a count is kept as it is."""
    keys = np.concatenate([keys for keys, _ in parts])
    counts = np.concatenate([counts for _, counts in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
    return keys[starts], np.add.reduceat(counts >> 1, starts) * 2 + (counts[starts] & 1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending numbers as their steps, in 32 bits if all fit; the first byte tells."""
    steps = np.diff(keys, prepend=np.uint64(0))
    small = len(steps) < 2 or steps[1:].max() < 1 << 32
    rest = steps[1:].astype("<u4" if small else "<u8").tobytes()
    return bytes([4 if small else 8]) + steps[:1].astype("<u8").tobytes() + rest


def unpacked_keys(data: bytes) -> np.ndarray:
    first = np.frombuffer(data, "<u8", 1, 1)
    rest = np.frombuffer(data, f"<u{data[0]}", offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([first, rest]), dtype=np.uint64)


def ngram_levels(ngrams: DataFrame) -> DataFrame:
    """``(block, at, data)``: for every row of n-grams the level of each, in the order of its keys.

    The n-grams of a range of hashes are counted over all blocks and entered into the range's slice of the filter,
    which is asked in the same task: no slice leaves it. A range holds a bounded part of the text, so a larger corpus
    has more slices and each n-gram keeps its place. Pairs that are too rare to enter the filter have level 0.
    """
    least = int(level_of(np.array([LEAST_PAIRS]))[0])

    def answer(table: pa.Table) -> pa.Table:
        lean()
        rows = table.to_pylist()
        own = [unpacked_keys(row["data"]) for row in rows]
        keys, counts = summed(
            [(part, unpacked(row["more"], np.uint32).astype(np.int64)) for part, row in zip(own, rows)]
        )
        lows = np.where(counts & 1 == 1, least, 1)
        levels = np.where(counts > 1, level_of(counts >> 1), 0)
        entered = levels >= lows
        found = build_filter(keys[entered], levels[entered]).levels(keys)
        # an n-gram that ends below the least level entered is known not to be there
        found = np.where(found < lows, 0, found).astype(np.uint8)
        return pa.table(
            {
                "block": pa.array([row["block"] for row in rows], pa.int64()),
                "at": pa.array([row["at"] for row in rows], pa.int32()),
                "data": pa.array([squeezed(found[np.searchsorted(keys, part)].tobytes()) for part in own], pa.binary()),
            }
        )

    grouped = ngrams.select(F.col("at").alias("segment"), "block", "at", "data", "more").groupBy("segment")
    return grouped.applyInArrow(answer, "block long, at int, data binary")


def least_levels(singles: list[int], pairs: list[int], most: int) -> tuple[int, int, int]:
    """The least levels of words and pairs that enter the filter, and the number of entries.

    Pairs below ``LEAST_PAIRS`` never do. If there are more than ``most`` entries, the rarest pairs are left to the
    words they are made of, then the rarest words to unseen ones. Scores set no such bound and do not ask this.
    """
    entries = lambda sizes, least: sum(level * n for level, n in enumerate(sizes) if level >= least)
    single, pair = 1, int(level_of(np.array([LEAST_PAIRS]))[0])
    while (total := entries(singles, single) + entries(pairs, pair)) > most:
        if pair < LEVELS:
            pair += 1
        else:
            single += 1
    return single, pair, total


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


class Levels:
    """The levels of the n-grams of a block, found by their keys."""

    def __init__(self, keys: np.ndarray, levels: np.ndarray):
        self.keys, self.levels = keys, levels

    def counts(self, keys: np.ndarray) -> np.ndarray:
        distinct, place = np.unique(keys, return_inverse=True)
        return count_of(self.levels[np.searchsorted(self.keys, distinct)].astype(np.int64))[place]


def line_scores(totals: Totals, found: Levels, hashes, counts, held, end: int, line: np.ndarray, lengths: np.ndarray):
    """Known tokens, base and score of documents of the given lengths, one after the other as numbers of words."""
    starts = np.cumsum(lengths) - lengths
    before = np.concatenate([[end], line[:-1]])
    before[starts] = end
    pairs = found.counts(pair_keys(hashes[before], hashes[line]))
    logs = log_probabilities(pairs, held[before], totals.single(held[line]))
    base = np.log10(totals.single(counts[line]))
    return tuple(np.add.reduceat(x, starts) for x in ((counts[line] > 0).astype(np.int64), base, logs))


def word_totals(words: DataFrame) -> DataFrame:
    """For every row of words their counts over all blocks.

    ``tokens`` and ``distinct`` are the sum of the counts and the number of the words that have one; only the first row
    of a range has them, for the whole range.
    """

    def value(rows: list[dict]) -> Iterator[tuple[bytes, int, int]]:
        lists = [words_in(row) for row in rows]
        totals: dict[bytes, int] = {}
        for own, row in zip(lists, rows):
            for word, n in zip(own, numbers_and_counts(row["extra"])[1].tolist()):
                totals[word] = totals.get(word, 0) + n
        tokens, distinct = sum(totals.values()), sum(n > 0 for n in totals.values())
        for own in lists:
            yield packed(np.array([totals[word] for word in own], np.uint64)), tokens, distinct
            tokens = distinct = 0

    return written(by_range(words, value, data="binary", tokens="long", distinct="long"), "lm-words")


def score_texts(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every text, see ``SCORES``, under counts of the texts where ``learns`` holds.

    A-Z are lower-cased; the tokens are the words and one end for each text. The base is exact: each
    distinct word's count is joined to the blocks that have it. ``score`` is that of a model of words and
    pairs of words whose quantised counts stand in a Bloom filter, a slice for each range of hashes; the distinct
    n-grams of each block are asked where their slice is made and the answers joined to the block.

    A null text is an empty one: it has the end as its only token. Rows that repeat a key stay, null
    keys count as empty text for the caller's split, and an empty table gives no rows. Without training texts
    every word has probability one by the base.
    """
    spark = docs.sparkSession
    ship(spark)
    source = texts(docs, key, text=text).select(
        F.col(key).cast("long").alias("key"), learns.alias("flag"), F.col(text).alias("text")
    )
    segments = segments_for(source, "text")

    def split():
        return lambda content: [*content.encode("utf-8", "surrogatepass").lower().split(), END]

    def rows(block: Block) -> Iterator[pa.RecordBatch]:
        yield from block.document_rows()
        yield from block.word_rows(segments)
        yield row_of(HASHES, block.number, at=block.words.index(END), data=packed_hashes(block.hashes))
        yield from ngram_rows(block, segments)

    path = new_folder(spark, "lm-blocks")
    tables = stored(coded(source, split, rows), path)
    totals = word_totals(tables[WORDS])
    delete(spark, f"{path}/kind={WORDS}")  # the totals are written, so no one reads the words again
    both = [F.coalesce(F.sum(name), F.lit(0)) for name in ("tokens", "distinct")]
    trained = Totals(*totals.agg(*both).first())

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        given, joined = left.to_pylist(), right.to_pylist()
        marked = next(row for row in given if row["kind"] == HASHES)
        hashes, end = unpacked_hashes(marked["data"]), marked["at"]
        counts = np.zeros(len(hashes), np.int64)
        for row in joined:
            if row["kind"] == WORDS:
                counts[numbers_and_counts(row["extra"])[0]] = unpacked(row["data"], np.uint64)
        lines = [
            (row, unpacked(row["data"], np.uint32), unpacked(row["more"], np.uint32).astype(np.int64))
            for row in given
            if row["kind"] == DOCUMENTS
        ]
        keys = [np.unique(single_keys(hashes))]
        for _, line, _ in lines:  # every text ends with END
            keys.append(np.unique(pair_keys(hashes[np.concatenate([[end], line[:-1]])], hashes[line])))
        answers = sorted((row for row in joined if row["kind"] == NGRAMS), key=lambda row: row["at"])
        levels = np.frombuffer(b"".join(stretched(row["data"]) for row in answers), np.uint8)
        found = Levels(np.unique(np.concatenate(keys)), levels)  # ranges in order have the keys in order
        held = found.counts(single_keys(hashes))
        parts = []
        for row, line, lengths in lines:
            known, base, logs = line_scores(trained, found, hashes, counts, held, end, line, lengths)
            parts.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["keys"], pa.int64()),
                        "held_out": pa.array([not flag for flag in row["flags"]], pa.bool_()),
                        "n_tokens": lengths,
                        "n_known": known,
                        "train_tokens": np.full(len(lengths), trained.tokens, np.int64),
                        "base_score": base,
                        "score": logs,
                    }
                )
            )
        return pa.concat_tables(parts)

    columns = ("kind", "block", "at", "keys", "flags", "data", "more")
    left = tables[DOCUMENTS].select(*columns).unionByName(tables[HASHES].select(*columns))
    worded = totals.select(F.lit(WORDS).alias("kind"), "block", F.lit(0).alias("at"), "data", "extra")
    answers = ngram_levels(tables[NGRAMS]).withColumns({"kind": F.lit(NGRAMS), "extra": F.lit(None).cast("binary")})
    right = worded.unionByName(answers)
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(score, SCORES)


def packed_hashes(hashes: np.ndarray) -> bytes:
    """The upper 40 bits of each; words that agree in them share their counts in the filter."""
    return (hashes >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpacked_hashes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").reshape(-1).astype(np.uint64)


def held_out(key: Column) -> Column:
    return remainder(key, 5) == 1


def document_scores(docs: DataFrame) -> DataFrame:
    return score_texts(docs, ~held_out(F.col("doc_id")))
