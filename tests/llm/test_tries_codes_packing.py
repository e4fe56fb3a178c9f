"""The prefix trie, vector codes and packing against plain Python, on the given tables and on awkward rows."""

import array
import hashlib
import math
import re
import zlib
from collections import defaultdict
from random import Random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagwright import session
from tagwright.llm import common, grouping, packing, prefix_trie, vector_codes
from tagwright.llm.queries import QUERIES
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = r"[^\x20\x09-\x0D]+"
TRIE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TURNS = "conv_id long, turn long, role string, text string"


# Prefix trie


def slow_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    built, members, children = {}, defaultdict(list), defaultdict(set)
    for conv in convs:
        convs[conv].sort(key=lambda turn: turn[:2])
    for conv in convs:
        h = zlib.crc32(str(conv).encode()) % 4
        turns = convs.get(conv - conv % 20, [])[:h] + convs[conv][h:]
        built[conv] = tuple(turn[2:] for turn in turns)
        for depth in range(len(turns) + 1):
            members[built[conv][:depth]].append(conv)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        words = len(re.findall(WORD, path[-1][1])) if path else 0
        for depth in range(len(path) + 1):
            saved[path[:depth]] += (len(own) - 1) * words
            leaves[path[:depth]] += not children[path]
    found = []
    for path, own in members.items():
        ends = ",".join(map(str, sorted(conv for conv in own if len(built[conv]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(own), len(path), parent, len(own), len(children[path]), leaves[path], saved[path], digest))
    return sorted(found, key=str)


def trie_rows(frame):
    return sorted((tuple(row) for row in prefix_trie.conversation_trie(frame).select(*TRIE).collect()), key=str)


def test_trie_of_the_given_conversations(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/conversations.parquet").select(*TURNS.replace(",", "").split()[::2]).collect()]
    found = sorted((tuple(row) for row in QUERIES["op11_prefix_trie"](spark, SMALL).select(*TRIE).collect()), key=str)
    assert found == slow_trie(rows)


def awkward_turns():
    source = Random(4)
    rows = [(conv, turn, "user", f"first {turn}") for conv in range(60) for turn in range(source.randrange(1, 4))]  # shared
    rows += [(conv, turn, None, None) for conv in (100, 101) for turn in (None, 1, 2)]  # nulls are empty
    rows += [(140, turn, "user", f"long {turn}") for turn in range(30)]
    rows += [(141, turn, "user", f"long {turn}") for turn in range(30)]
    rows += [(200, 0, "a", "bc"), (220, 0, "ab", "c")]  # alike only if run together
    rows += [(300, turn, "user", "same") for turn in (1, 1, 1, 1)]  # repeated rows
    rows += [(320, 0, "user", "word " * 50000), (None, 0, "user", "lost"), (-7, 0, "user", "below zero")]
    return rows


@pytest.mark.parametrize("cells", [None, 8])
def test_trie_of_awkward_conversations(spark, monkeypatch, cells):
    """Chunks of four turns, and a sketch so small that hardly any prefix is proven alone: the nodes stay the same."""
    monkeypatch.setattr(prefix_trie, "STEP_BITS", 2)
    if cells:
        monkeypatch.setattr(prefix_trie, "MOST_CELLS", cells)
        monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    rows = awkward_turns()
    frame = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("clash")).withColumn("conv", F.lit(1))
    assert trie_rows(frame) == slow_trie(rows)
    assert trie_rows(spark.createDataFrame([], TURNS)) == []


def test_estimates_of_one_are_proofs(spark):
    random = np.random.default_rng(1)
    digests = random.integers(-(2**62), 2**62, (500, 2))
    repeated = np.vstack([digests, digests[:40], digests[:10]])
    frame = spark.createDataFrame(repeated.tolist(), "d1 long, d2 long").repartition(4)
    sketch = prefix_trie.fit_sketch(frame)
    shared = sketch.shared(*digests.T.copy().view(np.uint64))
    assert shared[:40].all() and shared[40:].mean() < 0.05


# Vector codes


def slow_codes(vectors, parts=16, entries=64, rounds=2):
    kept = sorted(vectors)
    split = lambda v: [tuple(v[at * len(v) // parts : (at + 1) * len(v) // parts]) for at in range(parts)]
    rows = [split([math.floor(256 * x) for x in v]) for _, v in kept]
    books = [[row[part] for row in rows[:entries]] for part in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda book, p: min((far(entry, p), at) for at, entry in enumerate(book))
    for _ in range(rounds):
        for part, book in enumerate(books):
            groups = defaultdict(list)
            for row in rows:
                groups[nearest(book, row[part])[1]].append(row[part])
            books[part] = [
                tuple(sum(xs) // len(xs) for xs in zip(*groups[at])) if groups[at] else entry for at, entry in enumerate(book)
            ]
    found = []
    for (key, _), row in zip(kept, rows):
        best = [nearest(book, p) for book, p in zip(books, row)]
        found.append((key, "".join(f"{at:02x}" for _, at in best), sum(d for d, _ in best)))
    digest = ",".join(str(x) for book in books for entry in book for x in entry)
    return found, hashlib.sha256(digest.encode()).hexdigest()


def test_codes_against_plain_search(spark):
    random = np.random.default_rng(5)
    vectors = random.normal(size=(150, 32)).round(2).tolist()  # coarse, so that there are ties
    vectors[7] = vectors[3]
    odd = [(200, None, 1), (201, [None] * 32, 1), (202, [math.nan] + [0.0] * 31, 1), (203, [math.inf] * 32, None)]
    rows = [(at, vector, at % 3 or None) for at, vector in enumerate(vectors)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    frame = frame.withColumn("code", F.lit("clash")).withColumn("numbers", F.lit(1)).repartition(5)
    found = sorted(vector_codes.compressed_vectors(frame).collect())
    expected, digest = slow_codes([(at, vector) for at, vector, _ in rows])
    assert [(row["vec_id"], row["code"], row["error"]) for row in found] == expected
    assert {row["codebooks_sha256"] for row in found} == {digest}
    sums = defaultdict(int)
    for row in found:
        sums[row["label"]] += row["error"]
    assert all(row["label_error"] == sums[row["label"]] for row in found)


def test_neighbour_lists_find_the_first_nearest_entry():
    random = np.random.default_rng(2)
    for entries in (1, 2, 64):
        book, points = random.integers(-4, 5, (entries, 2)), random.integers(-6, 7, (400, 2))
        nearest, distance = vector_codes.Neighbours(book).nearest(points)
        apart = ((points[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        assert (nearest == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_awkward_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.compressed_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0] * 20, None), (1, [1e30] * 20, 1), (1, [1e30] * 20, 1), (2, [], 2), (3, [0.5] * 3, 2)]
    found = vector_codes.compressed_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str(row["vec_id"]) for row in found) == ["1", "1", "2", "3", "None"]
    assert all(row["error"] == 0 and len(row["code"]) == 32 for row in found)


def test_decoded_vectors_have_the_stated_error(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    numbers = vector_codes.integer_vectors(vectors, "vec_id")
    books = vector_codes.train_codebooks(numbers, entries=16, rounds=1)
    codes = vector_codes.decoded_vectors(vector_codes.vector_codes(numbers, books), books)
    whole = {row["vec_id"]: row["numbers"] for row in numbers.collect()}
    for row in codes.collect():
        steps = [round(x * 256 - 0.5) for x in row["decoded"]]
        assert sum((a - b) ** 2 for a, b in zip(steps, whole[row["vec_id"]])) == row["error"]


def test_hot_keys_stay_in_place(spark, tmp_path, monkeypatch):
    """Beyond the bound the frequent keys are broadcast and the others shuffled; null keys meet too."""
    rows = [(None if at % 3 == 0 else at % 50, at) for at in range(900)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "label int, n int").write.parquet(path)
    frame = spark.read.parquet(path)
    sums = frame.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total"))
    whole = sorted(common.attach(frame, sums, ["label"], "rows").collect(), key=str)
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common, "MOST_HOT", 20)
    assert sorted(common.attach(frame, sums, ["label"], "rows").collect(), key=str) == whole and len(whole) == 900


# Packing


def packed_as_asked(rows, texts, capacity=2048):
    """Checks every piece and its place; the number of sequences and of ids."""
    tokenizer = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append(row)
    for key, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        own, at = sorted(pieces[key], key=lambda row: row["piece"]), 0
        assert len(own) == -(-len(ids) // capacity)
        for number, row in enumerate(own):
            assert (row["piece"], row["start"]) == (number, at) and (number == 0 or row["length"] == capacity)
            assert row["ids_crc32"] == zlib.crc32(array.array("I", ids[at : at + row["length"]]).tobytes())
            at += row["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for row in sorted(own, key=lambda row: row["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= capacity
    return len(sequences), sum(row["length"] for row in rows)


@pytest.mark.parametrize("block", [2048, 16])
def test_packing(spark, monkeypatch, block):
    """In one block, and in small ones whose emptier sequences are pooled."""
    monkeypatch.setattr(packing, "BLOCK_PIECES", block)
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    n, ids = packed_as_asked(QUERIES["op13_packing"](spark, SMALL).collect(), docs)
    assert n <= math.ceil(ids / 2048) * (1.02 if block > 16 else 1.06) + 1


def test_packing_of_awkward_documents(spark):
    texts = {1: None, 2: "", 3: "word " * 30000, 4: " \t\n", 5: "é 漢字 😀", 6: "a", 7: "word " * 2047}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs = docs.withColumn("piece", F.lit("clash")).withColumn("number", F.lit(1))
    packed_as_asked(packing.document_packing(docs, PATH).collect(), texts)
    same = spark.createDataFrame([(None, "x"), (None, "x"), (1, "x"), (1, "x")], "doc_id long, text string")
    rows = packing.document_packing(same, PATH).collect()
    assert len(rows) == 4 and len({(row["sequence_id"], row["offset"]) for row in rows}) == 4
    assert packing.document_packing(docs.limit(0), PATH).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    tokenizer, ids = Tokenizer.from_file(PATH), {}
    for row in docs.collect():
        ids[row["doc_id"]] = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [0]
    found = defaultdict(list)
    for row in packing.packed_sequences(docs, PATH, capacity=256).collect():
        values = np.frombuffer(row["ids"], "<u4").tolist()
        assert len(values) <= 256
        for at, (doc, start) in enumerate(zip(row["doc_ids"], row["offsets"])):
            stop = row["offsets"][at + 1] if at + 1 < len(row["offsets"]) else len(values)
            found[doc].append(values[start:stop])
    # pieces of a document may stand in any sequences: together they are its ids
    assert {doc: sorted(sum(parts, [])) for doc, parts in found.items()} == {doc: sorted(own) for doc, own in ids.items()}


def test_children_keep_every_item_once():
    source = Random(0)
    for case in range(20):
        sizes = [source.randint(1, 99) for _ in range(source.randint(1, 200))]
        found = grouping.first_packings(sizes, 100, 4, source, plain=True)
        least = grouping.least_groups(np.array(sizes), 100)
        before = max(one.fitness for one in found)
        best = grouping.evolve(found, least, 6, source)[0]
        assert best.fitness >= before and len(best.groups) >= least >= math.ceil(sum(sizes) / 100)
        assert sorted(sum(best.groups, [])) == list(range(len(sizes)))
        assert best.fills == [sum(sizes[at] for at in group) for group in best.groups] and max(best.fills) <= 100
        again = grouping.Packing.from_bytes(sizes, 100, best.to_bytes())
        assert again.fitness == best.fitness


def test_bound_is_never_above_the_best_packing():
    def best(sizes, rooms=()):
        if not sizes:
            return len(rooms)
        first, rest = sizes[0], sizes[1:]
        options = [best(rest, rooms + (10 - first,))]
        options += [best(rest, rooms[:at] + (room - first,) + rooms[at + 1 :]) for at, room in enumerate(rooms) if room >= first]
        return min(options)

    source = Random(1)
    for _ in range(60):
        sizes = [source.randint(1, 10) for _ in range(7)]
        assert grouping.least_groups(np.array(sizes), 10) <= best(tuple(sizes))


def test_crossover_beats_plain_best_fit():
    """Sizes that best fit packs badly: three fit exactly, and the largest first leave gaps."""
    source = Random(3)
    sizes = [size for _ in range(60) for size in (source.randint(300, 380), source.randint(300, 380))]
    sizes += [1000 - a - b for a, b in zip(sizes[::2], sizes[1::2])]
    found = grouping.first_packings(sizes, 1000, 4, source, plain=True)
    assert len(grouping.evolve(found, 60, 60, source)[0].groups) < len(found[0].groups)
