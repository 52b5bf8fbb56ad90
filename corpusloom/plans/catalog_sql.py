"""The same queries as plain SQL, written independently of the Spark code, for a second engine to run."""

from __future__ import annotations

import math


# --- fixed values: what a token is, in this engine's notation ---
TOKEN_PATTERN = (
    r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2CEAF}\x{2F800}-\x{2FA1F}\p{P}\p{S}]"
    r"|[^\s\p{Z}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2CEAF}\x{2F800}-\x{2FA1F}\p{P}\p{S}]+"
)
SEED = 7
NL = "chr(10)"


def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{TOKEN_PATTERN}')"


def _cells(source: str, key: str = "doc_id", extra: str = "") -> str:
    """``key, pos, token`` of a relation with a token list ``toks``."""
    return f"SELECT {key}{extra}, generate_subscripts(toks, 1) AS pos, unnest(toks) AS token FROM {source}"


def _vocab(cells: str, first: int = 4) -> str:
    """Ranked tokens after ``first`` reserved ids."""
    return (
        f"SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + {first - 1} AS INTEGER) AS id "
        f"FROM (SELECT token, count(*) AS n FROM ({cells}) GROUP BY token)"
    )


# documents as tokens, their cells, the vocabulary, and cells with ids
DOCS = f"""
tok AS MATERIALIZED (SELECT doc_id, {_tokens('text')} AS toks FROM documents),
cells AS MATERIALIZED ({_cells('tok')}),
vocab AS MATERIALIZED ({_vocab('SELECT token FROM cells')}),
ids AS MATERIALIZED (SELECT doc_id, pos, coalesce(id, 1) AS id FROM cells LEFT JOIN vocab USING (token))
"""

# English titled documents with a one-newline separator, split by the last 500 documents
LYRICS = f"""
cut AS (SELECT min(doc_id) AS c FROM (SELECT doc_id FROM documents ORDER BY doc_id DESC LIMIT 500)),
lyr AS MATERIALIZED (
  SELECT doc_id, doc_id >= c AS is_test, 'The lyrics of "' || source || '":' || {NL} || text AS body
  FROM documents, cut WHERE lang = 'en')
"""

# their ids over the vocabulary of the training side, with the following id
LYRIC_IDS = f"""
{LYRICS},
ltok AS MATERIALIZED (SELECT doc_id, is_test, {_tokens('body')} AS toks FROM lyr),
lcells AS MATERIALIZED ({_cells('ltok', extra=', is_test')}),
lvocab AS MATERIALIZED ({_vocab('SELECT token FROM lcells WHERE NOT is_test')}),
lids AS MATERIALIZED (
  SELECT doc_id, is_test, pos, coalesce(id, 1) AS a,
         lead(coalesce(id, 1)) OVER (PARTITION BY doc_id ORDER BY pos) AS b
  FROM lcells LEFT JOIN lvocab USING (token)),
domain AS MATERIALIZED (
  SELECT a, b, count(*) AS n FROM lids WHERE NOT is_test AND b IS NOT NULL GROUP BY a, b)
"""

# counts of the background and of the adapted model, and losses of test documents cut to 1024 tokens
LOSSES = f"""
{LYRIC_IDS},
btok AS (SELECT item_id, {_tokens('text')} AS toks FROM benchmark),
bcells AS ({_cells('btok', 'item_id')}),
bids AS (
  SELECT coalesce(id, 1) AS a, lead(coalesce(id, 1)) OVER (PARTITION BY item_id ORDER BY pos) AS b
  FROM bcells LEFT JOIN lvocab USING (token)),
background AS MATERIALIZED (SELECT a, b, count(*) AS n FROM bids WHERE b IS NOT NULL GROUP BY a, b),
counts AS MATERIALIZED (
  SELECT 'original' AS model, a, b, n FROM background
  UNION ALL
  SELECT 'finetuned', a, b, CAST(sum(n) AS BIGINT)
  FROM (SELECT * FROM background UNION ALL SELECT * FROM domain) GROUP BY a, b),
contexts AS MATERIALIZED (SELECT model, a, sum(n) AS n_context FROM counts GROUP BY model, a),
size AS (SELECT count(*) + 4 AS v FROM lvocab),
heads AS MATERIALIZED (
  SELECT doc_id, a, b, count(*) OVER (PARTITION BY doc_id) AS n_tokens, pos
  FROM lids WHERE is_test AND pos <= 1024),
steps AS (SELECT doc_id, n_tokens, a, b FROM heads WHERE pos < n_tokens),
losses AS MATERIALIZED (
  SELECT model, doc_id, n_tokens AS n,
         avg(-ln((coalesce(c.n, 0) + 1.0::DOUBLE) / (coalesce(x.n_context, 0) + v))) AS loss
  FROM (SELECT s.*, m.model FROM steps s, (VALUES ('original'), ('finetuned')) AS m(model)) s
  CROSS JOIN size
  LEFT JOIN counts c USING (model, a, b)
  LEFT JOIN contexts x USING (model, a)
  GROUP BY model, doc_id, n_tokens),
ppl AS (SELECT model, exp(sum(loss * n) / sum(n)) AS ppl FROM losses GROUP BY model)
"""

# test pairs inside the budget, and the two stand-in answers
PAIRS = f"""
{LYRICS},
parts AS (SELECT doc_id, string_split(body, {NL}) AS p FROM lyr WHERE is_test),
pairs AS MATERIALIZED (
  SELECT doc_id,
         array_to_string(p[1:len(p) - 1], {NL}) || {NL} AS input,
         p[len(p)] AS reference,
         string_split(array_to_string(p[1:len(p) - 1], {NL}) || {NL}, {NL}) AS lines
  FROM parts),
kept AS MATERIALIZED (
  SELECT doc_id, input, reference, lines[2] AS cand_original, lines[len(lines) - 1] AS cand_finetuned
  FROM pairs WHERE len({_tokens('input')}) + 100 <= 1024),
answers AS MATERIALIZED (
  SELECT doc_id, 'original' AS model, {_tokens('cand_original')} AS cand, {_tokens('reference')} AS ref FROM kept
  UNION ALL
  SELECT doc_id, 'finetuned', {_tokens('cand_finetuned')}, {_tokens('reference')} FROM kept)
"""


def _match(source: str, keys: str) -> str:
    """Exact-match scores of token lists ``cand`` and ``ref``."""
    return f"""
sided AS (
  SELECT {keys}, 0 AS side, unnest(cand) AS token FROM {source}
  UNION ALL SELECT {keys}, 1, unnest(ref) FROM {source}),
tf AS (
  SELECT {keys}, token, count(*) FILTER (WHERE side = 0) AS c, count(*) FILTER (WHERE side = 1) AS r
  FROM sided GROUP BY {keys}, token),
hits AS (
  SELECT {keys}, CAST(sum(c) AS DOUBLE) AS nc, CAST(sum(r) AS DOUBLE) AS nr,
         coalesce(sum(c) FILTER (WHERE r > 0), 0) AS hc, coalesce(sum(r) FILTER (WHERE c > 0), 0) AS hr
  FROM tf GROUP BY {keys}),
pr AS (
  SELECT {keys}, CASE WHEN coalesce(nc, 0) = 0 THEN 0.0::DOUBLE ELSE hc / nc END AS precision,
         CASE WHEN coalesce(nr, 0) = 0 THEN 0.0::DOUBLE ELSE hr / nr END AS recall
  FROM {source} LEFT JOIN hits USING ({keys})),
scores AS (
  SELECT {keys}, precision, recall,
         CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE
              ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM pr)
"""


ROUNDED = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"

# speaker-tagged turns
TAGGED = """
tagged AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations),
pieces AS (
  SELECT conv_id, turn, role, pos,
         CASE WHEN pos % 2 = 0 THEN '[speaker1]' ELSE '[speaker2]' END || text || '[SEP]' AS by_pos,
         CASE WHEN role = 'assistant' THEN '[speaker2]' ELSE '[speaker1]' END || text || '[SEP]' AS by_role
  FROM tagged)
"""


def _history(piece: str) -> str:
    return (
        f"'[CLS]' || string_agg({piece}, '') OVER (PARTITION BY conv_id ORDER BY pos "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) || '[speaker2]'"
    )


PROMPTS = f"""
WITH {TAGGED}
SELECT conv_id, turn, out FROM (SELECT conv_id, turn, pos, {_history('by_pos')} AS out FROM pieces) WHERE pos % 2 = 0
"""

SEGMENTS = f"string_split(text, {NL})"
INPUT = f"array_to_string(p[1:len(p) - 1], {NL}) || {NL}"

NUMBERED = """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, source AS title, text AS body, lang FROM documents"""



def _corpus(records: str, key: str, kept: int, length: int, vocab_from: str = "SELECT token FROM ccells", wrap: bool = False) -> str:
    """Blocks of a relation ``recs (key, body)``: ``kept`` text tokens of ``length`` ids."""
    body = "list_concat(list_concat([2], b), [3])" if wrap else "b"
    return f"""
        WITH {records},
        ctok AS MATERIALIZED (SELECT *, {_tokens('body')} AS toks FROM recs),
        ccells AS MATERIALIZED ({_cells('ctok', key)}),
        cvocab AS MATERIALIZED ({_vocab(vocab_from)}),
        cids AS (SELECT {key}, pos, coalesce(id, 1) AS id FROM ccells LEFT JOIN cvocab USING (token) WHERE pos <= {kept}),
        cbody AS (
          SELECT {key}, coalesce(list(id ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS b
          FROM recs LEFT JOIN cids USING ({key}) GROUP BY {key}),
        wrapped AS (SELECT {key}, {body} AS w FROM cbody)
        SELECT {key}, CAST(len(w) AS INTEGER) AS n_tokens, CAST(len(w) AS INTEGER) AS n_mask,
               array_to_string(w, ' ') || repeat(' 0', CAST({length} - len(w) AS INTEGER)) AS out,
               array_to_string(w, ' ') || repeat(' 0', CAST({length} - len(w) AS INTEGER)) AS labels
        FROM wrapped"""


FLAT = f"replace(replace(replace(text, {NL} || {NL}, '。'), {NL}, '。'), ' ', '，')"

def _smoothed(k: int, n: int = 3) -> str:
    """Probabilities of the grams of ``k`` ids, and what their contexts leave."""
    ids = ", ".join(f"w{i}" for i in range(n - k + 1, n + 1))
    before = ids.rpartition(", ")[0]
    disc = f"d{k} AS (SELECT count(*) FILTER (n = 1) / (count(*) FILTER (n = 1) + 2 * count(*) FILTER (n = 2))::DOUBLE AS d FROM c{k})"
    if k == 1:
        return f"""{disc},
        floor AS (SELECT coalesce((SELECT d FROM d1) * count(*) / sum(n)::DOUBLE, 1.0) / (SELECT count(*) + 4 FROM lvocab) AS f, sum(n) AS total FROM c1),
        p1 AS MATERIALIZED (SELECT w{n}, (n - d) / total + f AS p FROM c1, d1, floor)"""
    lower = ids.partition(", ")[2]
    return f"""{disc},
        x{k} AS MATERIALIZED (SELECT {before}, sum(n) AS total, d * count(*) / sum(n)::DOUBLE AS left_over FROM c{k}, d{k} GROUP BY {before}, d),
        p{k} AS MATERIALIZED (SELECT {ids}, (c.n - d) / total + left_over * q.p AS p
          FROM c{k} c JOIN x{k} USING ({before}) JOIN p{k - 1} q USING ({lower}), d{k})"""


# trigrams of the lyrics with their predecessors, counted, and smoothed
KNESER_NEY = f"""
{LYRIC_IDS},
grams AS MATERIALIZED (
  SELECT doc_id, is_test, pos, coalesce(lag(a, 2) OVER w, -1) AS w1, lag(a) OVER w AS w2, a AS w3 FROM lids
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
c3 AS MATERIALIZED (SELECT w1, w2, w3, count(*) AS n FROM grams WHERE NOT is_test AND pos > 1 GROUP BY ALL),
c2 AS MATERIALIZED (SELECT w2, w3, count(*) AS n FROM c3 GROUP BY ALL),
c1 AS MATERIALIZED (SELECT w3, count(*) AS n FROM c2 GROUP BY ALL),
{_smoothed(1)}, {_smoothed(2)}, {_smoothed(3)}
"""

# --- fixed values: cumulated probabilities of a Poisson number of mean 1 ---
POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(17)]

def _class(length: str) -> str:
    """The length that stands for the class of an exact one: classes grow by 101 / 99."""
    factor = "(101.0::DOUBLE / 99)"
    return f"CASE WHEN {length} < 1 THEN 0.0 ELSE 2 * pow({factor}, ceil(ln({length}) / ln({factor}) - 1e-9)) / ({factor} + 1) END"


ORACLE: dict[str, str] = {
    # sources and sinks
    "s1_lyrics_csv": NUMBERED,
    "s1_lyrics_csv_parallel": NUMBERED,
    "s2_preview": "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5",
    "s3_json_records": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, text AS output FROM documents",
    "s4_dialogs_json": """
        SELECT CAST(conv_id AS VARCHAR) AS dialog_id, 'd' || conv_id AS document_id,
               CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS turn, text
        FROM conversations""",
    "s5_id_list": "SELECT CAST(doc_id AS VARCHAR) AS id FROM labels WHERE quality = 1",
    "s6_text_tree": "SELECT source AS artist, CAST(doc_id AS VARCHAR) AS song, text FROM documents",
    "s7_prompts": f"SELECT text || {NL} AS text FROM benchmark",
    "s8_write_examples": f"""
        WITH cut AS (SELECT min(doc_id) AS c FROM (SELECT doc_id FROM documents ORDER BY doc_id DESC LIMIT 500))
        SELECT doc_id, CASE WHEN doc_id >= c THEN 'test' ELSE 'train' END AS split,
               'The lyrics of "' || source || '":' || {NL} || {NL} || text AS text
        FROM documents, cut WHERE lang = 'en'""",
    "s9_example_count": """
        WITH ranked AS (SELECT lang, row_number() OVER (ORDER BY doc_id DESC) AS r FROM documents)
        SELECT CASE WHEN r <= 500 THEN 'test' ELSE 'train' END AS split, count(*) AS n
        FROM ranked WHERE lang = 'en' GROUP BY ALL""",
    # filters and splits
    "f1_language": "SELECT doc_id, lang FROM documents WHERE lang = 'en'",
    "f2_nonnull": "SELECT doc_id, lang FROM documents WHERE text IS NOT NULL",
    "f3_listed": """
        SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "f3_unlisted": """
        SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "f4_tail_holdout": "SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) <= 500 AS is_test FROM documents",
    "f5_group_holdout": """
        WITH g AS (SELECT source, row_number() OVER (ORDER BY source DESC) AS r
                   FROM (SELECT DISTINCT source FROM documents))
        SELECT doc_id, CASE WHEN r <= 1 THEN 'eval' WHEN r <= 10 THEN 'heldout' ELSE 'train' END AS role
        FROM documents JOIN g USING (source)""",
    "f6_budget": f"""
        SELECT doc_id, CAST(n AS INTEGER) AS n_tokens
        FROM (SELECT doc_id, len({_tokens('text')}) AS n FROM documents) WHERE n + 100 <= 1024""",
    "f7_drop_empty": "SELECT doc_id, lang FROM documents WHERE trim(text) <> '' AND trim(source) <> ''",
    # text projections
    "t1_prompt": f"""
        SELECT doc_id, 'The lyrics of "' || coalesce(source, 'nan') || '":' || {NL} || {NL} || coalesce(text, 'nan')
               AS out FROM documents""",
    "t2_flatten": f"""
        SELECT doc_id, replace(replace(replace(text, {NL} || {NL}, '。'), {NL}, '。'), ' ', '，') AS out
        FROM documents""",
    "t3_newlines": f"SELECT doc_id, text || {NL} AS out FROM documents",
    "t4_segments": f"""
        SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, unnest(p) AS segment
        FROM (SELECT doc_id, {SEGMENTS} AS p FROM documents)""",
    "t5_last_segment": f"""
        SELECT doc_id, {INPUT} AS input, p[len(p)] AS reference
        FROM (SELECT doc_id, {SEGMENTS} AS p FROM documents)""",
    "t6_random_cut": f"""
        WITH parts AS (SELECT doc_id, {SEGMENTS} AS p FROM documents),
        cuts AS (
          SELECT doc_id, p,
                 ('0x' || substr(md5(doc_id || ':{SEED}'), 1, 8))::BIGINT % (len(p) - 1) + 1 AS n
          FROM parts WHERE len(p) >= 2)
        SELECT doc_id, CAST(n AS INTEGER) AS n, array_to_string(p[1:n], {NL}) || {NL} AS input,
               array_to_string(p[n + 1:], {NL}) AS reference FROM cuts""",
    "t7_head": f"""
        SELECT doc_id, array_to_string(p[1:10], {NL}) || {NL} AS input
        FROM (SELECT doc_id, {SEGMENTS} AS p FROM documents)""",
    "t8_strip_prompt": f"""
        SELECT doc_id, p[len(p)] || {NL} || {NL} || {INPUT} AS out
        FROM (SELECT doc_id, {SEGMENTS} AS p FROM documents)""",
    "t9_first_paragraph": f"SELECT doc_id, p[len(p)] AS out FROM (SELECT doc_id, {SEGMENTS} AS p FROM documents)",
    "t10_strip_spaces": "SELECT doc_id, replace(text, ' ', '') AS out FROM documents",
    # dialogues
    "c1_dialog": f"""
        WITH {TAGGED}
        SELECT conv_id, '[CLS]' || string_agg(by_pos, '' ORDER BY pos) AS out FROM pieces GROUP BY conv_id""",
    "c2_dialogs": """
        SELECT conv_id, count(*) AS n, string_agg(text, '|' ORDER BY turn) AS out FROM conversations GROUP BY conv_id""",
    "c2_round_trip": """
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, text FROM conversations""",
    "c3_prompts": PROMPTS,
    "c3_prompts_by_role": f"""
        WITH {TAGGED}
        SELECT conv_id, turn, out
        FROM (SELECT conv_id, turn, role, {_history('by_role')} AS out FROM pieces) WHERE role = 'user'""",
    "c3_prompts_in_context": f"""
        WITH {TAGGED},
        sized AS (
          SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY pos) AS upto
          FROM (SELECT p.*, len({_tokens('c.text')}) + 2 AS n FROM pieces p JOIN conversations c USING (conv_id, turn)))
        SELECT a.conv_id, a.turn, '[CLS]' || string_agg(b.by_pos, '' ORDER BY b.pos) || '[speaker2]' AS out,
               CAST(sum(b.n) + 2 AS INTEGER) AS n_tokens, min(b.pos) AS n_left_out
        FROM sized a JOIN sized b ON b.conv_id = a.conv_id AND b.pos <= a.pos AND (b.pos = a.pos OR a.upto - b.upto + b.n <= 98)
        WHERE a.pos % 2 = 0 GROUP BY a.conv_id, a.turn""",
    "c4_reply": """
        SELECT conv_id, turn, coalesce(replace(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), ' ', ''), '') AS out
        FROM conversations""",
    "c5_ordered_stream": PROMPTS,
    "c5_history_stream": PROMPTS.replace("turn, out FROM (SELECT", "turn, out, 0::BIGINT AS n_late FROM (SELECT"),
    # corpora
    "lyrics_corpus": _corpus(
        f"""numbered AS ({NUMBERED}),
        recs AS (SELECT ordinal, 'The lyrics of "' || title || '":' || {NL} || {NL} || numbered.body AS body FROM numbered
                 WHERE lang = 'en' AND ordinal < (SELECT count(*) - 500 FROM documents))""",
        "ordinal", 1024, 1024,
    ),
    "news_corpus": _corpus(
        "recs AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, text AS body FROM documents)",
        "ordinal", 1020, 1022, wrap=True,
    ),
    "song_corpus": _corpus(
        f"""g AS (SELECT source, row_number() OVER (ORDER BY source DESC) AS r FROM (SELECT DISTINCT source FROM documents)),
        recs AS (SELECT source || '/' || doc_id AS song_id, {FLAT} AS body FROM documents JOIN g USING (source) WHERE r > 10),
        alltok AS (SELECT {_tokens(FLAT)} AS toks FROM documents)""",
        "song_id", 1020, 1022, "SELECT unnest(toks) AS token FROM alltok", wrap=True,
    ),
    # tokens and blocks
    "k1_tokens": f"""
        WITH tok AS (SELECT doc_id, {_tokens('text')} AS toks FROM documents)
        SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, token FROM ({_cells('tok')})""",
    "k2_token_count": f"SELECT doc_id, CAST(len({_tokens('text')}) AS INTEGER) AS n_tokens FROM documents",
    "k3_vocab": f"""
        WITH {DOCS}
        SELECT id, token FROM vocab
        UNION ALL SELECT * FROM (VALUES (0, '[PAD]'), (1, '[UNK]'), (2, '[CLS]'), (3, '[SEP]'))
        UNION ALL SELECT CAST(count(*) + 4 AS INTEGER), '[speaker1]' FROM vocab
        UNION ALL SELECT CAST(count(*) + 5 AS INTEGER), '[speaker2]' FROM vocab""",
    "k4_ids": f"""
        WITH {DOCS}
        SELECT doc_id, coalesce(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos), '') AS out
        FROM documents LEFT JOIN ids USING (doc_id) GROUP BY doc_id""",
    "k4_subwords": f"""
        WITH RECURSIVE {DOCS},
        frequent AS (SELECT token FROM vocab WHERE id < 1504),
        pieces AS MATERIALIZED (
          SELECT piece, starts_with(piece, '##') AND piece <> '##' AS inside, row_number() OVER (ORDER BY piece) + 3 AS id
          FROM (SELECT DISTINCT unnest([token, token[:1], token[:2], token[:3],
                  '##' || right(token, 1), '##' || right(token, 2), '##' || right(token, 3), '##' || right(token, 4)]) AS piece FROM frequent)),
        walk AS (
          SELECT DISTINCT token, 0::BIGINT AS at_char, []::BIGINT[] AS ids FROM cells WHERE len(token) <= 100
          UNION ALL
          SELECT token, at_char + l, list_append(ids, id) FROM (
            SELECT token, at_char, ids, l, id, row_number() OVER (PARTITION BY token ORDER BY l DESC) AS r
            FROM (SELECT *, unnest(generate_series(1, len(token) - at_char)) AS l FROM walk WHERE at_char < len(token)) w
            JOIN pieces p ON p.inside = (at_char > 0) AND p.piece = CASE WHEN at_char > 0 THEN '##' ELSE '' END || substr(token, at_char + 1, l))
          WHERE r = 1),
        cut AS (SELECT token, ids FROM walk WHERE at_char = len(token))
        SELECT doc_id, coalesce(string_agg(array_to_string(coalesce(cut.ids, [1]), ' '), ' ' ORDER BY pos) FILTER (WHERE pos IS NOT NULL), '') AS out
        FROM documents LEFT JOIN cells USING (doc_id) LEFT JOIN cut USING (token) GROUP BY doc_id""",
    "k5_packed": f"""
        WITH {DOCS}
        SELECT doc_id, CAST((count(*) + 1023) // 1024 AS INTEGER) AS n_parts, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS out
        FROM ids GROUP BY doc_id""",
    "k5_block": f"""
        WITH {DOCS},
        body AS (
          SELECT doc_id, coalesce(list(id ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS b
          FROM documents LEFT JOIN (SELECT * FROM ids WHERE pos <= 1020) USING (doc_id) GROUP BY doc_id),
        wrapped AS (SELECT doc_id, list_concat(list_concat([2], b), [3]) AS w FROM body)
        SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, CAST(len(w) AS INTEGER) AS n_mask,
               array_to_string(w, ' ') || repeat(' 0', CAST(1022 - len(w) AS INTEGER)) AS out
        FROM wrapped""",
    "k5_chat_block": f"""
        WITH ttok AS (SELECT conv_id, {_tokens('text')} AS toks FROM conversations),
        tcells AS ({_cells('ttok', 'conv_id')}),
        vocab AS MATERIALIZED ({_vocab('SELECT token FROM tcells')}),
        turns AS (
          SELECT conv_id, turn, {_tokens('text')} AS toks,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p FROM conversations
          WHERE conv_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
        words AS (SELECT conv_id, p, pos, token FROM (
          SELECT conv_id, p, generate_subscripts(toks, 1) AS pos, unnest(toks) AS token FROM turns)),
        marks AS (
          SELECT conv_id, -1 AS p, 0 AS pos, 2 AS id FROM turns WHERE p = 0
          UNION ALL SELECT conv_id, p, 0, (SELECT count(*) FROM vocab) + 4 + p % 2 FROM turns
          UNION ALL SELECT conv_id, p, 1000000000, 3 FROM turns
          UNION ALL SELECT conv_id, p, pos, coalesce(id, 1) FROM words LEFT JOIN vocab USING (token)),
        blocks AS (SELECT conv_id, (list(id ORDER BY p, pos))[1:1022] AS b FROM marks GROUP BY conv_id)
        SELECT conv_id, CAST(len(b) AS INTEGER) AS n_tokens,
               array_to_string(b, ' ') || repeat(' 0', CAST(1022 - len(b) AS INTEGER)) AS out
        FROM blocks""",
    "chat_corpus": f"""
        WITH ttok AS (SELECT conv_id, {_tokens('text')} AS toks FROM conversations),
        tcells AS ({_cells('ttok', 'conv_id')}),
        vocab AS MATERIALIZED ({_vocab('SELECT token FROM tcells')}),
        turns AS (
          SELECT conv_id, turn, {_tokens('text')} AS toks,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p FROM conversations
          WHERE conv_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
        words AS (SELECT conv_id, p, pos, token FROM (
          SELECT conv_id, p, generate_subscripts(toks, 1) AS pos, unnest(toks) AS token FROM turns)),
        marks AS (
          SELECT conv_id, -1 AS p, 0 AS pos, 2 AS id FROM turns WHERE p = 0
          UNION ALL SELECT conv_id, p, 0, (SELECT count(*) FROM vocab) + 4 + p % 2 FROM turns
          UNION ALL SELECT conv_id, p, 1000000000, 3 FROM turns
          UNION ALL SELECT conv_id, p, pos, coalesce(id, 1) FROM words LEFT JOIN vocab USING (token)),
        blocks AS (SELECT conv_id, (list(id ORDER BY p, pos))[1:1022] AS b FROM marks GROUP BY conv_id)
        SELECT CAST(conv_id AS VARCHAR) AS dialog_id, CAST(len(b) AS INTEGER) AS n_tokens, CAST(len(b) AS INTEGER) AS n_mask,
               array_to_string(b, ' ') || repeat(' 0', CAST(1022 - len(b) AS INTEGER)) AS out,
               array_to_string(b, ' ') || repeat(' 0', CAST(1022 - len(b) AS INTEGER)) AS labels
        FROM blocks""",
    "k6_decode": f"""
        WITH {DOCS}
        SELECT doc_id, coalesce(string_agg(CASE WHEN vocab.id IS NULL THEN '[UNK]' ELSE token END, ' ' ORDER BY pos), '')
               AS out
        FROM documents LEFT JOIN cells USING (doc_id) LEFT JOIN vocab USING (token) GROUP BY doc_id""",
    "k7_truncation": f"""
        WITH n AS (SELECT len({_tokens('text')}) AS n_tokens FROM documents)
        SELECT count(*) AS n_docs, count(*) FILTER (WHERE n_tokens > 1020) AS n_over,
               round(avg(CASE WHEN n_tokens > 1020 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS share_over,
               CAST(sum(greatest(n_tokens - 1020, 0)) AS BIGINT) AS tokens_lost FROM n""",
    "k7_length_sketch": f"""
        WITH n AS (SELECT source, len({_tokens('text')}) AS n FROM documents),
        ranked AS (
          SELECT source, n, row_number() OVER (PARTITION BY source ORDER BY n) AS r, count(*) OVER (PARTITION BY source) AS c FROM n),
        exact AS (
          SELECT source, min(n) FILTER (r >= ceil(0.5 * c)) AS e50, min(n) FILTER (r >= ceil(0.9 * c)) AS e90, min(n) FILTER (r >= ceil(0.99 * c)) AS e99,
                 min(n) FILTER (r >= ceil(0.95 * c)) AS e95 FROM ranked GROUP BY source),
        classed AS (
          SELECT source, {_class('e50')} AS p50, {_class('e90')} AS p90, {_class('e99')} AS p99, {_class('e95')} AS p95 FROM exact)
        SELECT source, round(p50, 6) AS p50, round(p90, 6) AS p90, round(p99, 6) AS p99,
               CAST(pow(2, ceil(log2(greatest(p95 * 0.99, 1.0)))) AS BIGINT) AS block FROM classed""",
    # batches
    "b1_batches": f"""
        WITH epochs AS (SELECT CAST(unnest(range(3)) AS INTEGER) AS epoch),
        ranked AS (
          SELECT epoch, doc_id, row_number() OVER (
            PARTITION BY epoch ORDER BY md5('{SEED}:' || epoch || ':' || doc_id), doc_id) - 1 AS r
          FROM documents, epochs)
        SELECT epoch, r // 4 AS step, CAST(r % 4 AS INTEGER) AS slot, doc_id FROM ranked""",
    "b2_schedule": """
        WITH size AS (SELECT (count(*) + 3) // 4 AS per FROM documents),
        steps AS (SELECT per, per * 3 AS total, unnest(range(per * 3)) AS step FROM size)
        SELECT step, CAST(step // per AS INTEGER) AS epoch,
               round(3e-5::DOUBLE * CASE WHEN step < 10 THEN step / 10.0::DOUBLE
                 ELSE greatest(0, (total - step) / greatest(1, total - 10)::DOUBLE) END, 12) AS lr
        FROM steps""",
    "b3_metric_summary": """
        SELECT event_type AS tag, event_id // 1000 AS epoch, count(value) AS n, round(avg(value), 6) AS avg,
               min(value) AS min, max(value) AS max, arg_max(value, event_id) AS last
        FROM events GROUP BY ALL""",
    # evaluation
    "e1_bigrams": f"WITH {LYRIC_IDS} SELECT a, b, n FROM domain",
    "e2_loss": f"""
        WITH {LOSSES} SELECT doc_id, round(loss, 6) AS loss, CAST(n AS INTEGER) AS n FROM losses
        WHERE model = 'finetuned'""",
    "e1_kneser_ney": f"WITH {KNESER_NEY} SELECT concat_ws(' ', w1, w2, w3) AS gram, round(p, 9) AS p FROM p3",
    "e2_loss_kneser_ney": f"""
        WITH {KNESER_NEY},
        sizes AS (SELECT doc_id, CAST(least(count(*), 1024) AS INTEGER) AS n FROM lids GROUP BY doc_id),
        scored AS (
          SELECT doc_id, coalesce(p3.p, coalesce(x3.left_over, 1.0) * coalesce(p2.p, coalesce(x2.left_over, 1.0) * coalesce(p1.p, f))) AS p
          FROM grams g LEFT JOIN p3 USING (w1, w2, w3) LEFT JOIN x3 ON x3.w1 = g.w1 AND x3.w2 = g.w2
          LEFT JOIN p2 ON p2.w2 = g.w2 AND p2.w3 = g.w3 LEFT JOIN x2 ON x2.w2 = g.w2 LEFT JOIN p1 ON p1.w3 = g.w3, floor
          WHERE is_test AND pos BETWEEN 2 AND 1024)
        SELECT doc_id, round(avg(-ln(p)), 6) AS loss, n FROM scored JOIN sizes USING (doc_id) GROUP BY doc_id, n""",
    "e3_ppl": f"WITH {LOSSES} SELECT model, round(ppl, 6) AS ppl FROM ppl",
    "e4_pairs": f"WITH {PAIRS} SELECT doc_id, input, reference, cand_original, cand_finetuned FROM kept",
    "e4_cut_pairs": f"""
        WITH last AS (SELECT max(source) AS source FROM documents),
        parts AS (
          SELECT doc_id, string_split(
            replace(replace(replace(text, {NL} || {NL}, '。'), {NL}, '。'), ' ', '，'), '。') AS p
          FROM documents JOIN last USING (source)),
        cuts AS (
          SELECT doc_id, p,
                 ('0x' || substr(md5(doc_id || ':{SEED}'), 1, 8))::BIGINT % (len(p) - 1) + 1 AS n
          FROM parts WHERE len(p) >= 2),
        rows AS (
          SELECT doc_id, CAST(n AS INTEGER) AS n, array_to_string(p[1:n], '。') || '。' AS input,
                 array_to_string(p[n + 1:], '。') AS reference FROM cuts)
        SELECT *, CAST(len({_tokens('input')}) AS INTEGER) AS n_tokens FROM rows
        WHERE len({_tokens('input')}) + 100 <= 1024""",
    "e5_match": f"WITH {PAIRS}, {_match('answers', 'doc_id, model')} SELECT doc_id, model, {ROUNDED} FROM scores",
    "e5_match_documents": f"""
        WITH parts AS (SELECT doc_id, {SEGMENTS} AS p FROM documents),
        answers AS MATERIALIZED (
          SELECT doc_id, {_tokens(INPUT)} AS cand, {_tokens('p[len(p)]')} AS ref FROM parts),
        {_match('answers', 'doc_id')}
        SELECT doc_id, {ROUNDED} FROM scores""",
    "e5_match_vectors": f"""
        WITH {PAIRS}, {DOCS},
        vec AS MATERIALIZED (
          SELECT token, CAST(embedding AS DOUBLE[]) AS v FROM (
            SELECT token, id FROM vocab
            UNION ALL SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3)))
          JOIN embeddings ON vec_id = id),
        c AS MATERIALIZED (SELECT doc_id, model, token, count(*) AS n, any_value(v) AS v FROM (
          SELECT doc_id, model, unnest(cand) AS token FROM answers) LEFT JOIN vec USING (token) GROUP BY ALL),
        r AS MATERIALIZED (SELECT doc_id, model, token, count(*) AS n, any_value(v) AS v FROM (
          SELECT doc_id, model, unnest(ref) AS token FROM answers) LEFT JOIN vec USING (token) GROUP BY ALL),
        sims AS MATERIALIZED (
          SELECT doc_id, model, c.token AS ct, r.token AS rt, c.n AS cn, r.n AS rn,
                 CASE WHEN c.token = r.token THEN 1.0::DOUBLE
                      ELSE coalesce(list_cosine_similarity(c.v, r.v), 0.0) END AS s
          FROM c JOIN r USING (doc_id, model)),
        p AS (SELECT doc_id, model, sum(cn * best) / sum(cn) AS precision FROM (
          SELECT doc_id, model, ct, any_value(cn) AS cn, max(s) AS best FROM sims GROUP BY ALL) GROUP BY ALL),
        q AS (SELECT doc_id, model, sum(rn * best) / sum(rn) AS recall FROM (
          SELECT doc_id, model, rt, any_value(rn) AS rn, max(s) AS best FROM sims GROUP BY ALL) GROUP BY ALL),
        pr AS (
          SELECT doc_id, model, coalesce(precision, 0.0) AS precision, coalesce(recall, 0.0) AS recall
          FROM answers LEFT JOIN p USING (doc_id, model) LEFT JOIN q USING (doc_id, model)),
        scores AS (
          SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE
                         ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr)
        SELECT doc_id, model, {ROUNDED} FROM scores""",
    "e6_mean": f"""
        WITH {PAIRS}, {_match('answers', 'doc_id, model')}
        SELECT model, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
               round(avg(f1), 6) AS f1, count(*) AS n FROM scores GROUP BY model""",
    "e7_compare": f"""
        WITH {PAIRS}, {_match('answers', 'doc_id, model')}, {LOSSES.split(LYRICS, 1)[1].lstrip(' ,' + chr(10))},
        means AS (SELECT model, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1
                  FROM scores GROUP BY model),
        metrics AS (
          SELECT 'precision' AS metric, model, precision AS value FROM means
          UNION ALL SELECT 'recall', model, recall FROM means
          UNION ALL SELECT 'f1', model, f1 FROM means
          UNION ALL SELECT 'ppl', model, ppl FROM ppl)
        SELECT metric, round(max(value) FILTER (WHERE model = 'original'), 6) AS original,
               round(max(value) FILTER (WHERE model = 'finetuned'), 6) AS finetuned
        FROM metrics GROUP BY metric""",
    "e7_intervals": f"""
        WITH {PAIRS}, {_match('answers', 'doc_id, model')}, {LOSSES.split(LYRICS, 1)[1].lstrip(' ,' + chr(10))},
        rows AS (
          SELECT doc_id, model, unnest(['precision', 'recall', 'f1']) AS metric, unnest([precision, recall, f1]) AS value, 1.0::DOUBLE AS weight FROM scores
          UNION ALL SELECT doc_id, model, 'ppl', loss, n::DOUBLE FROM losses),
        drawn AS (
          SELECT *, ('0x' || substr(md5('{SEED}:' || replicate || ':' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
          FROM rows, (SELECT unnest(generate_series(0, 200)) AS replicate)),
        counted AS (
          SELECT *, weight * CASE WHEN replicate = 0 THEN 1 ELSE len(list_filter({POISSON}::DOUBLE[], lambda c: c <= u)) END AS w FROM drawn),
        means AS (
          SELECT metric, replicate, model, CASE WHEN metric = 'ppl' THEN exp(sum(w * value) / sum(w)) ELSE sum(w * value) / sum(w) END AS value
          FROM counted GROUP BY 1, 2, 3 HAVING sum(w) > 0),
        long AS (
          SELECT * FROM means
          UNION ALL
          SELECT metric, replicate, 'difference', b.value - a.value FROM means a JOIN means b USING (metric, replicate)
          WHERE a.model = 'original' AND b.model = 'finetuned'),
        ranked AS (
          SELECT metric, model, value, row_number() OVER (PARTITION BY metric, model ORDER BY value) AS r FROM long WHERE replicate > 0)
        SELECT metric, model, round(any_value(l.value), 6) AS value, round(max(k.value) FILTER (r = 5), 6) AS low, round(max(k.value) FILTER (r = 196), 6) AS high
        FROM long l JOIN ranked k USING (metric, model) WHERE replicate = 0 GROUP BY metric, model""",
    "split_summary": f"""
        WITH ranked AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC) AS r FROM documents),
        rows AS (
          SELECT CASE WHEN r <= 500 THEN 'test' ELSE 'train' END AS split,
                 'The lyrics of "' || source || '":' || {NL} || {NL} || text AS body
          FROM ranked WHERE lang = 'en')
        SELECT split, count(*) AS n, CAST(sum(len({_tokens('body')})) AS BIGINT) AS n_tokens FROM rows GROUP BY split""",
}

# the same answers by the other way of meeting a table
for _name in ("k4_ids", "k6_decode", "e5_match_vectors"):
    ORACLE[f"{_name}_joined"] = ORACLE[_name]
for _name in ("s3_json_records", "s4_dialogs_json"):
    ORACLE[f"{_name}_parallel"] = ORACLE[_name]
ORACLE["s6_text_tree_source"] = ORACLE["s6_text_tree"]
ORACLE["b3_metric_stream"] = ORACLE["b3_metric_summary"]
