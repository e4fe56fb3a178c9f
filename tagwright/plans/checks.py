"""The queries as SQL for another engine, each over the whole tables.

Models are scored by the plain formula here, a sum over the words of a post of the class's log likelihoods,
while the queries rearrange it.
"""

from __future__ import annotations

from fractions import Fraction

from tagwright.fixed_values import BASELINE_ACCURACY, HASH_SLOTS

SPACE = r"[ \t\n\x0B\f\r]"

TAGS = """tags AS (
  SELECT doc_id AS Id, lang AS Tag FROM documents WHERE lang IS NOT NULL
  UNION ALL SELECT doc_id, source FROM documents WHERE source IS NOT NULL
  UNION ALL SELECT doc_id, 'quality' FROM labels WHERE quality = 1
  UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1)"""

VOCAB = """tag_n AS (SELECT Tag, count(*) AS n FROM tags GROUP BY Tag),
vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, Tag) - 1 AS INTEGER) AS catId, Tag, n
  FROM tag_n ORDER BY n DESC, Tag LIMIT 100)"""
TOP_TAGS = VOCAB.replace("LIMIT 100", "LIMIT 10")

IN_TRAINING = "CAST('0x' || substr(md5(CAST({id} AS VARCHAR)), 1, 8) AS UBIGINT) % 10 < 7"

WORDS = rf"""texts AS (
  SELECT doc_id AS Id, lower(text) AS low, regexp_replace(lower(text), '{SPACE}+$', '') AS trimmed FROM documents
  WHERE text IS NOT NULL),
words AS (
  SELECT Id, CASE WHEN trimmed = '' AND low <> '' THEN [] ELSE string_split_regex(trimmed, '{SPACE}') END AS words
  FROM texts)"""

TF = f"""{WORDS},
tokens AS (SELECT Id, unnest(words) AS term FROM words),
tf AS (SELECT Id, term, count(*) AS tf FROM tokens GROUP BY Id, term)"""

# Hashed slots: 32-bit MurmurHash3 with seed 42 over the bytes of each distinct word, modulo the slots.
MASK = "4294967295"


def mixed(block: str) -> str:
    """A block of four bytes or fewer, as it enters the hash."""
    first = f"(({block}) * 3432918353 & {MASK})"
    turned = f"((({first} << 15) | ({first} >> 17)) & {MASK})"
    return f"({turned} * 461845907 & {MASK})"


HASHED = f"""{TF},
distinct_terms AS (SELECT DISTINCT term FROM tf),
bytes AS (SELECT term, hex(encode(term)) AS hx, octet_length(encode(term)) AS len FROM distinct_terms),
little AS (
  SELECT term, hx, len, list_transform(range(CAST((len + 3) // 4 AS BIGINT)), lambda i: list_reduce(
    list_prepend(0::UBIGINT, list_transform(range(least(4, len - 4 * i)),
      lambda j: CAST('0x' || substr(hx, CAST(8 * i + 2 * j + 1 AS BIGINT), 2) AS UBIGINT) << CAST(8 * j AS UBIGINT))),
    lambda a, b: a | b)) AS blocks
  FROM bytes),
hashes AS (
  SELECT term, xor(list_reduce(list_prepend(42::UBIGINT, list_transform(blocks, lambda b: {mixed('b')})[1:len // 4]),
    lambda h, k: ((((xor(h, k) << 13) | (xor(h, k) >> 19)) & {MASK}) * 5 + 3864292196) & {MASK}),
    xor(CASE WHEN len % 4 > 0 THEN {mixed('blocks[-1]')} ELSE 0::UBIGINT END, CAST(len AS UBIGINT))) AS h0
  FROM little),
hashes1 AS (SELECT term, xor(h0, h0 >> 16) * 2246822507 & {MASK} AS h1 FROM hashes),
hashes2 AS (SELECT term, xor(h1, h1 >> 13) * 3266489909 & {MASK} AS h2 FROM hashes1),
hashes3 AS (SELECT term, xor(h2, h2 >> 16) AS h3 FROM hashes2),
signed AS (
  SELECT term, CASE WHEN h3 >= 2147483648 THEN CAST(h3 AS BIGINT) - 4294967296 ELSE CAST(h3 AS BIGINT) END AS h
  FROM hashes3),
slots AS (SELECT term, CAST((h % {HASH_SLOTS} + {HASH_SLOTS}) % {HASH_SLOTS} AS INTEGER) AS slot FROM signed),
slot_tf AS (SELECT Id, slot, CAST(sum(tf) AS BIGINT) AS tf FROM tf JOIN slots USING (term) GROUP BY Id, slot)"""


HELD = "NOT " + IN_TRAINING


def model(features: str, feature: str, hashed: bool, scored: str = HELD) -> str:
    """Training, scores and best class of the ``scored`` posts, over ``features`` (Id, ``feature``, tf)."""
    n_features = str(HASH_SLOTS) if hashed else "(SELECT count(*) FROM idf)"
    # A hashed slot without a training row keeps a weight; a word without one is unknown.
    known = "LEFT JOIN idf" if hashed else "JOIN idf"
    unseen = "ln((SELECT n FROM n_rows) + 1.0)" if hashed else "0.0"
    return f"""
train AS (
  SELECT t.Id, v.catId AS CatId FROM tags t JOIN vocab v USING (Tag) JOIN documents d ON d.doc_id = t.Id
  WHERE d.text IS NOT NULL AND {IN_TRAINING.format(id='t.Id')}),
n_rows AS (SELECT count(*) AS n FROM train),
class_n AS (SELECT CatId, count(*) AS n_c FROM train GROUP BY CatId),
counts AS (
  SELECT CatId, {feature}, sum(f.tf) AS tf, count(*) AS df FROM train JOIN {features} f USING (Id)
  GROUP BY CatId, {feature}),
idf AS (
  SELECT {feature}, ln(((SELECT n FROM n_rows) + 1.0) / (sum(df) + 1.0)) AS idf FROM counts GROUP BY {feature}),
weights AS (SELECT CatId, {feature}, tf * idf AS weight FROM counts JOIN idf USING ({feature})),
class_w AS (SELECT CatId, sum(weight) AS s_c FROM weights GROUP BY CatId),
classes AS (
  SELECT CatId, n_c, ln(n_c + 1.0) - ln((SELECT n FROM n_rows) + (SELECT count(*) FROM class_n)) AS log_prior,
    ln(s_c + {n_features}) AS log_total
  FROM class_n JOIN class_w USING (CatId)),
held AS (SELECT doc_id AS Id FROM documents WHERE text IS NOT NULL AND {scored.format(id='doc_id')}),
x AS (
  SELECT f.Id, {feature}, f.tf * coalesce(idf, {unseen}) AS x FROM {features} f {known} USING ({feature})
  WHERE f.Id IN (SELECT Id FROM held)),
likelihoods AS (
  SELECT x.Id, c.CatId, sum(x.x * (ln(coalesce(w.weight, 0.0) + 1.0) - c.log_total)) AS l
  FROM x CROSS JOIN classes c LEFT JOIN weights w ON w.CatId = c.CatId AND w.{feature} = x.{feature}
  GROUP BY x.Id, c.CatId),
scores AS (
  SELECT h.Id, c.CatId, v.Tag, c.log_prior + coalesce(l.l, 0.0) AS score
  FROM held h CROSS JOIN classes c JOIN vocab v ON v.catId = c.CatId
  LEFT JOIN likelihoods l ON l.Id = h.Id AND l.CatId = c.CatId),
tops AS (SELECT Id, max(score) AS top FROM scores GROUP BY Id),
posterior AS (
  SELECT Id, CatId, Tag, exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY Id) AS probability, score
  FROM scores JOIN tops USING (Id)),
predicted AS (
  SELECT Id, CatId, Tag, probability FROM posterior
  QUALIFY row_number() OVER (PARTITION BY Id ORDER BY score DESC, CatId) = 1),
true_rows AS (
  SELECT p.Id, p.CatId AS prediction, v.catId AS CatId
  FROM predicted p JOIN tags t USING (Id) JOIN vocab v ON v.Tag = t.Tag),
by_post AS (SELECT Id, max(CAST(prediction = CatId AS DOUBLE)) AS hit FROM true_rows GROUP BY Id)"""


EXACT = f"WITH {TAGS}, {VOCAB}, {TF}, {model('tf', 'term', hashed=False)}"
SLOTTED = f"WITH {TAGS}, {VOCAB}, {HASHED}, {model('slot_tf', 'slot', hashed=True)}"


def tagged(features: str, feature: str, hashed: bool, scored: str) -> str:
    """The tag of each ``scored`` post."""
    words = HASHED if hashed else TF
    return f"""WITH {TAGS}, {VOCAB}, {words}, {model(features, feature, hashed, scored)}
SELECT Id, Tag AS tags FROM predicted"""


ALL_EXACT = tagged("tf", "term", False, "true")
ALL_SLOTTED = tagged("slot_tf", "slot", True, "true")
BASELINE = f"CAST({BASELINE_ACCURACY!r} AS DOUBLE)"

FULL_POSTS = """full_posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS Id, CASE WHEN lang = 'en' THEN 'post ' || doc_id END AS Title, text AS Body,
    source AS OwnerUserId, '2024-01-01T00:00:00Z' AS CreationDate, 'NA' AS ClosedDate,
    CAST(n_chars AS VARCHAR) AS Score
  FROM documents)"""

USER_POSTS = """user_posts AS (
  SELECT conv_id || '-' || turn AS Id, text AS Body, CAST(conv_id AS VARCHAR) AS OwnerUserId
  FROM conversations WHERE role = 'user' AND text IS NOT NULL)"""

POST_UPDATES = """updates AS (
  SELECT CAST(conv_id AS VARCHAR) AS Id, CASE WHEN role = 'system' THEN text END AS Title,
    CASE WHEN role = 'user' THEN text END AS Body, role AS OwnerUserId, '2024-01-01T00:00:00Z' AS CreationDate,
    'NA' AS ClosedDate, CAST(length(text) AS VARCHAR) AS Score,
    CASE WHEN role = 'assistant' THEN 'answered' END AS tag, turn
  FROM conversations)"""

EVENT_UPDATES = """updates AS (
  SELECT user_id, ts, event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
    CASE WHEN event_type <> 'view' THEN props END AS props
  FROM events)"""


def last_filled(column: str, order: str) -> str:
    """The latest value of ``column`` that is not null."""
    return f"(list({column} ORDER BY {order}) FILTER (WHERE {column} IS NOT NULL))[-1] AS {column}"


def merged(columns: list[str], key: str, order: str) -> str:
    return f"SELECT {key}, {', '.join(last_filled(c, order) for c in columns)} FROM updates GROUP BY {key}"


CHECKS: dict[str, str] = {
    "posts_scan": "SELECT doc_id AS Id, text AS Body FROM documents",
    "json_posts": f"WITH {FULL_POSTS} SELECT * FROM full_posts",
    "csv_tags": f"WITH {TAGS} SELECT CAST(Id AS VARCHAR) AS Id, Tag FROM tags",
    "csv_label_vocab": f"WITH {TAGS}, {TOP_TAGS} SELECT catId, Tag FROM vocab",
    "decode_posts": f"WITH {USER_POSTS} SELECT Id, CAST(NULL AS VARCHAR) AS Title, Body, OwnerUserId FROM user_posts",
    "rejected_posts": "SELECT text AS value FROM conversations WHERE role <> 'user'",
    "normalize_submissions": f"""WITH {USER_POSTS}
SELECT Id, 'NA' AS Title, Body, OwnerUserId, '2024-01-01T10:20:30Z' AS CreationDate, 'NA' AS ClosedDate, 'NA' AS Score
FROM user_posts""",
    "post_tags": f"WITH {TAGS} SELECT Id, Tag FROM tags",
    "tag_counts": f"WITH {TAGS} SELECT Tag, count(*) AS n FROM tags GROUP BY Tag",
    "label_vocab": f"WITH {TAGS}, {TOP_TAGS} SELECT catId, Tag, n FROM vocab",
    "select_tags": f"WITH {TAGS}, {TOP_TAGS} SELECT Id, Tag FROM tags WHERE Tag IN (SELECT Tag FROM vocab)",
    "training_rows": f"""WITH {TAGS}, {VOCAB}
SELECT t.Tag, d.text AS Body, t.Id FROM tags t JOIN vocab v USING (Tag) JOIN documents d ON d.doc_id = t.Id
WHERE d.text IS NOT NULL""",
    "labeled_rows": f"""WITH {TAGS}, {VOCAB}
SELECT t.Tag, t.Id, CAST(v.catId AS DOUBLE) AS CatId FROM tags t JOIN vocab v USING (Tag)""",
    "tag_sets": f"WITH {TAGS} SELECT Id, string_agg(DISTINCT Tag, ',' ORDER BY Tag) AS tags FROM tags GROUP BY Id",
    "split_by_key": f"SELECT doc_id AS Id, {IN_TRAINING.format(id='doc_id')} AS in_training FROM documents",
    "split_parts": f"""SELECT doc_id AS Id,
  CASE WHEN place < {int(7.5 * 2**56)} THEN 0 WHEN place < {round(Fraction("7.9") * 2**56)} THEN 1 ELSE 2 END AS part
FROM (SELECT doc_id, CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS UBIGINT) % 10 AS BIGINT) * {2**56}
  + CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 9, 14) AS BIGINT) AS place FROM documents)""",
    "preview_posts": "SELECT doc_id AS Id, text AS Body FROM documents ORDER BY doc_id LIMIT 4",
    "tokenize": f"""WITH {WORDS}
SELECT Id, len(words) AS n_words, coalesce(array_to_string(words, ' '), '') AS words FROM words""",
    "term_frequency": f"WITH {TF} SELECT Id, term, tf FROM tf",
    "document_frequency": f"WITH {TF} SELECT term, count(*) AS df FROM tf GROUP BY term",
    "idf": f"""WITH {TF}
SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM texts) + 1.0) / (count(*) + 1.0)), 6) AS idf
FROM tf GROUP BY term""",
    "tfidf": f"""WITH {TF},
idf AS (SELECT term, ln(((SELECT count(*) FROM texts) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY term)
SELECT Id, term, round(tf * idf, 6) AS weight FROM tf JOIN idf USING (term)""",
    "hashing_tf": f"WITH {HASHED} SELECT Id, slot, tf FROM slot_tf",
    "class_prior": f"""{EXACT}
SELECT c.CatId, v.Tag, c.n_c AS n_rows, round(c.log_prior, 6) AS log_prior
FROM classes c JOIN vocab v ON v.catId = c.CatId""",
    "class_term_weight": f"""{EXACT}
SELECT w.CatId, w.term, round(weight, 4) AS weight, round(ln(weight + 1.0) - log_total, 6) AS log_likelihood
FROM weights w JOIN classes c ON c.CatId = w.CatId
UNION ALL SELECT CatId, NULL, 0.0, round(-log_total, 6) FROM classes""",
    "nb_scores": f"{EXACT} SELECT Id, CatId, Tag AS tags, round(score, 4) AS score FROM scores",
    "class_posterior": f"{EXACT} SELECT Id, CatId, round(probability, 6) AS probability FROM posterior",
    "predict_class": f"{EXACT} SELECT Id, CatId, round(probability, 6) AS confidence FROM predicted",
    "predicted_tag": f"{EXACT} SELECT Id, Tag AS tags FROM predicted",
    "nb_predict": f"{SLOTTED} SELECT Id, Tag AS tags FROM predicted",
    "nb_confidence": f"{SLOTTED} SELECT Id, Tag AS tags, round(probability, 6) AS confidence FROM predicted",
    "accuracy": f"""{EXACT}
SELECT count(*) AS n, round(avg(CAST(prediction = CatId AS DOUBLE)), 6) AS accuracy FROM true_rows""",
    "accuracy_vs_baseline": f"""{EXACT}
SELECT count(*) AS n, round(avg(CAST(prediction = CatId AS DOUBLE)), 6) AS accuracy, {BASELINE} AS baseline,
  round(avg(CAST(prediction = CatId AS DOUBLE)) / {BASELINE}, 6) AS relative
FROM true_rows""",
    "accuracy_any": f"{EXACT} SELECT count(*) AS n, round(avg(hit), 6) AS accuracy FROM by_post",
    "train_summary": f"""{SLOTTED}
SELECT 1 AS version, (SELECT CAST(count(*) AS INTEGER) FROM classes) AS n_classes, count(*) AS n_rows,
  round(avg(CAST(prediction = CatId AS DOUBLE)), 6) AS accuracy,
  round(avg(CAST(prediction = CatId AS DOUBLE)) / {BASELINE}, 6) AS relative,
  (SELECT count(*) FROM by_post) AS n_posts, (SELECT round(avg(hit), 6) FROM by_post) AS accuracy_any
FROM true_rows""",
    "tagged_json": f"""WITH {FULL_POSTS}
SELECT Id AS key, CAST(CASE WHEN Title IS NULL THEN json_object('Id', Id, 'Body', Body, 'tags', OwnerUserId)
  ELSE json_object('Id', Id, 'Title', Title, 'Body', Body, 'tags', OwnerUserId) END AS VARCHAR) AS value
FROM full_posts""",
    "tagged_sink": f"WITH {FULL_POSTS} SELECT Id, Title, Body, OwnerUserId AS tags FROM full_posts",
    "stored_table": f"WITH {FULL_POSTS} SELECT Id, Title, Score, OwnerUserId AS tag FROM full_posts",
    "latest_post": f"""WITH {POST_UPDATES}
SELECT * FROM updates QUALIFY row_number() OVER (PARTITION BY Id ORDER BY turn DESC) = 1""",
    "merged_post": f"WITH {POST_UPDATES} "
    + merged(["Title", "Body", "OwnerUserId", "CreationDate", "ClosedDate", "Score", "tag"], "Id", "turn"),
    "lookup_tag": """SELECT r.Id, d.lang AS tag
FROM (SELECT DISTINCT user_id AS Id FROM events) r LEFT JOIN documents d ON d.doc_id = r.Id""",
    "score_stream": ALL_EXACT,
    "score_stream_hashed": ALL_SLOTTED,
    "score_stream_plan": ALL_SLOTTED,
    "score_stream_refresh": f"""SELECT * FROM ({tagged('slot_tf', 'slot', True, IN_TRAINING)})
UNION ALL SELECT * FROM ({tagged('tf', 'term', False, HELD)})""",
    "stream_fates": f"""WITH {USER_POSTS}
SELECT Id, Body, CAST(NULL AS VARCHAR) AS rejected, CAST(NULL AS VARCHAR) AS reason FROM user_posts
UNION ALL SELECT NULL, NULL, text, 'not a JSON object' FROM conversations WHERE role <> 'user'""",
    "upsert_replay": f"""WITH {EVENT_UPDATES}
SELECT * FROM updates QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_stream": f"""WITH {EVENT_UPDATES}
SELECT * FROM updates QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "message_fates": f"""WITH {USER_POSTS}
SELECT Id, Body, CAST(NULL AS VARCHAR) AS rejected, CAST(NULL AS VARCHAR) AS reason FROM user_posts
UNION ALL SELECT NULL, NULL, text, 'not a JSON object' FROM conversations WHERE role <> 'user'""",
    "upsert_ties": f"""WITH {POST_UPDATES}
SELECT * EXCLUDE (turn) FROM updates QUALIFY row_number() OVER (PARTITION BY Id ORDER BY turn DESC) = 1""",
    "merge_stream": f"WITH {EVENT_UPDATES} " + merged(["event_type", "value", "props"], "user_id", "ts, event_id"),
    "upsert_levels": f"""WITH {EVENT_UPDATES}
SELECT * FROM updates QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "merge_levels": f"WITH {EVENT_UPDATES} " + merged(["event_type", "value", "props"], "user_id", "ts, event_id"),
    "lookup_in_levels": """SELECT r.Id, d.lang AS tag
FROM (SELECT DISTINCT user_id AS Id FROM events) r LEFT JOIN documents d ON d.doc_id = r.Id""",
    "lookup_newest_user": """SELECT doc_id AS Id, lang AS tag FROM documents
WHERE doc_id = (SELECT user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)""",
}
CHECKS["score_stream_recovered"] = CHECKS["score_stream_once"] = ALL_SLOTTED
CHECKS["upsert_recovered"] = CHECKS["upsert_stream"]
CHECKS["nb_predict_sparse"] = CHECKS["nb_confidence"]
CHECKS["class_term_weight_added"] = CHECKS["class_term_weight"]
