"""Building blocks of the SQL that checks the queries in another engine.

It works differently on purpose: ids are numbers framed by blanks, patterns do
without look-ahead, and training is a recursive query that makes one merge per
step.
"""

from __future__ import annotations

from corpusloom.catalog.base import BATCH_COLS, BATCH_ROWS, MERGES, ROWS_PER_GROUP, ROWS_PER_SHARD, WINDOW, WORLD
from corpusloom.functions.patterns import CHAT_SPECIALS

# Unicode white space; the second form lacks CR and LF.
W = r"\t\n\x0b\f\r\x{85}\p{Z}"
W2 = r"\t\x0b\f\x{85}\p{Z}"
# Put before the last blank of a run that something else follows.
MARK = r"\x{E000}"

GPT2 = rf"''(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{W}\p{{L}}\p{{N}}{MARK}]+|[{W}]+|{MARK}"


def digits(n: int) -> str:
    """The two patterns that differ in how many digits make a chunk."""
    return (
        rf"(?i:''(?:[sdmt\x{{17F}}]|ll|ve|re))|[^\r\n\p{{L}}\p{{N}}{MARK}]?\p{{L}}+|\p{{N}}{{1,{n}}}"
        rf"| ?[^{W}\p{{L}}\p{{N}}{MARK}]+[\r\n]*|[{W}]*[\r\n]|[{W}]+|{MARK}"
    )


GPT4 = digits(3)
CHAT = digits(2)


def split(text: str, pattern: str) -> str:
    """SQL for the list of chunks of a text."""
    blank = W if pattern is GPT2 else W2
    marked = rf"regexp_replace({text}, '([{W}])([{blank}])([^{W}])', '\1' || chr(57344) || '\2\3', 'g')"
    return f"list_filter(regexp_extract_all({marked}, '{pattern}'), lambda x: x <> chr(57344))"


def numbered(keys: str, chunks: str, source: str, name: str = "chunk") -> str:
    """SQL for one row per list element with its position."""
    return (
        f"SELECT {keys}, unnest(l) AS {name}, generate_subscripts(l, 1) - 1 AS pos "
        f"FROM (SELECT {keys}, {chunks} AS l FROM {source})"
    )


def framed(text: str) -> str:
    """SQL for the bytes of a text, each as `` number ``."""
    hexed = rf"regexp_replace(hex(encode({text})), '(..)', ' \1 ', 'g')"
    numbers = f"list_transform(string_split(trim({hexed}), '  '), lambda x: ' ' || ('0x' || x)::INT || ' ')"
    return f"list_aggregate({numbers}, 'string_agg', '')"


def id_list(seq: str) -> str:
    return f"list_transform(string_split(trim({seq}), '  '), lambda x: x::BIGINT)"


def training(pattern: str | None, merges: int, first_seen: bool = False) -> str:
    """CTEs ``ch, uq, w0, w, merges, enc``: chunks, their counts, each step's words, the merges, the final ids."""
    chunks = split("text", pattern) if pattern else "CASE WHEN text = '' THEN [] ELSE [text] END"
    first = "min((doc_id, pos))" if first_seen else "0"
    tie = "min((f, j))" if first_seen else "(a, b)"
    return f"""
ch AS ({numbered("doc_id", chunks, "documents")}),
uq AS (SELECT chunk, count(*) AS c, {first} AS f FROM ch GROUP BY chunk),
w0 AS (SELECT chunk, c, f, {framed("chunk")} AS s FROM uq),
w(step, chunk, s, c, f, a, b, n) AS (
  SELECT 0::BIGINT, chunk, s, c, f, -1::BIGINT, -1::BIGINT, 0::HUGEINT FROM w0
  UNION ALL
  SELECT w.step + 1, w.chunk, replace(w.s, ' ' || m.a || '  ' || m.b || ' ', ' ' || (256 + w.step) || ' '),
         w.c, w.f, m.a, m.b, m.n
  FROM w, (
    SELECT a, b, sum(c)::HUGEINT AS n FROM (
      SELECT c, f, j, i[j] AS a, i[j + 1] AS b FROM (
        SELECT c, f, i, unnest(range(1, len(i))) AS j FROM (SELECT c, f, {id_list("s")} AS i FROM w)))
    GROUP BY a, b ORDER BY n DESC, {tie} LIMIT 1) m
  WHERE w.step < {merges}),
merges AS MATERIALIZED (SELECT DISTINCT step - 1 AS rnk, a, b, n FROM w WHERE step > 0),
enc AS MATERIALIZED (SELECT chunk, c, {id_list("s")} AS ids FROM w WHERE step = (SELECT max(step) FROM w))"""


def with_training(query: str, pattern: str | None = CHAT, merges: int = MERGES, first_seen: bool = False, more: str = "") -> str:
    return f"WITH RECURSIVE {training(pattern, merges, first_seen)}{more} {query}"


# ``vocab(id, h)``: hex bytes of every base and merged token.
VOCAB = """,
v(step, arr) AS (
  SELECT 0, list_transform(range(0, 256), lambda x: printf('%02X', x))
  UNION ALL
  SELECT v.step + 1, list_append(v.arr, v.arr[m.a + 1] || v.arr[m.b + 1]) FROM v JOIN merges m ON m.rnk = v.step),
vocab AS MATERIALIZED (
  SELECT generate_subscripts(arr, 1) - 1 AS id, unnest(arr) AS h FROM v WHERE step = (SELECT max(step) FROM v))"""

# ``specials(id, token)``: the special tokens after the last rank.
SPECIALS = """,
specials AS MATERIALIZED (
  SELECT (SELECT 256 + count(*) FROM merges) + generate_subscripts(l, 1) - 1 AS id, unnest(l) AS token
  FROM (SELECT [{}] AS l))""".format(", ".join(f"'{s}'" for s in CHAT_SPECIALS))

# ``encoded(doc_id, ids)``: documents without a BOS token.
ENCODED = """,
encoded AS MATERIALIZED (
  SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM ch JOIN enc USING (chunk) GROUP BY doc_id)"""

SHARDS = (
    f"doc_id // {ROWS_PER_SHARD} AS shard_idx, (doc_id % {ROWS_PER_SHARD}) // {ROWS_PER_GROUP} AS rg_idx"
)


def stream(keep: str = "true", world: int = WORLD, epochs: int = 1, order: str = "epoch, doc_id") -> str:
    """CTEs ``docs, toks``: BOS-prefixed documents, and every token with its place in the stream of its rank.

    ``keep`` may use ``epoch, shard_idx, rg_idx, rank, last_shard``.
    """
    return f"""{SPECIALS}{ENCODED},
docs AS MATERIALIZED (
  SELECT * FROM (
    SELECT d.doc_id, epoch, {SHARDS}, ((d.doc_id % {ROWS_PER_SHARD}) // {ROWS_PER_GROUP}) % {world} AS rank,
           (SELECT max(doc_id) // {ROWS_PER_SHARD} FROM documents) AS last_shard,
           list_prepend((SELECT min(id) FROM specials), coalesce(e.ids, [])) AS ids
    FROM documents d LEFT JOIN encoded e USING (doc_id), range({epochs}) r(epoch))
  WHERE {keep}),
toks AS MATERIALIZED (
  SELECT rank, shard_idx, rg_idx, tok,
         row_number() OVER (PARTITION BY rank ORDER BY {order}, k) - 1 AS place
  FROM (SELECT rank, epoch, doc_id, shard_idx, rg_idx, unnest(ids) AS tok, generate_subscripts(ids, 1) AS k FROM docs))"""


def windows(length: int = WINDOW) -> str:
    """CTE ``wins``: the full windows."""
    return f""",
wins AS MATERIALIZED (
  SELECT rank, place // {length} AS win, list(tok ORDER BY place) AS tokens,
         max_by(shard_idx, place) AS shard_idx, max_by(rg_idx, place) AS rg_idx
  FROM toks GROUP BY rank, place // {length} HAVING count(*) = {length})"""


BATCHES = f"""
SELECT rank, win AS batch_id, r AS "row", shard_idx, rg_idx,
       array_to_string(tokens[r * {BATCH_COLS} + 1 : r * {BATCH_COLS} + {BATCH_COLS}], ' ') AS inputs,
       array_to_string(tokens[r * {BATCH_COLS} + 2 : r * {BATCH_COLS} + {BATCH_COLS} + 1], ' ') AS targets
FROM wins, range({BATCH_ROWS}) t(r)"""


# Hex bytes framed by blanks, rewritten to the well-formed ones of the decoded text; every
# ill-formed sequence becomes the replacement character. A mark instead of the blank means done.
_REPLACED = "_EF_BF_BD"
_WELL_FORMED = [
    (r" (C[2-9A-F]|D.) ([89AB].)", r"_\1_\2"),
    (r" (E0) ([AB].) ([89AB].)", r"_\1_\2_\3"),
    (r" (E[1-9A-CEF]) ([89AB].) ([89AB].)", r"_\1_\2_\3"),
    (r" (ED) ([89].) ([89AB].)", r"_\1_\2_\3"),
    (r" (F0) ([9AB].) ([89AB].) ([89AB].)", r"_\1_\2_\3_\4"),
    (r" (F[123]) ([89AB].) ([89AB].) ([89AB].)", r"_\1_\2_\3_\4"),
    (r" (F4) (8.) ([89AB].) ([89AB].)", r"_\1_\2_\3_\4"),
    (r" F0 [9AB]. [89AB].| F[123] [89AB]. [89AB].| F4 8. [89AB].", _REPLACED),
    (r" E0 [AB].| E[1-9A-CEF] [89AB].| ED [89].| F0 [9AB].| F[123] [89AB].| F4 8.", _REPLACED),
    (r" [89A-F].", _REPLACED),
    (r" ([0-7].)", r"_\1"),
]


def lossy_hex(hexed: str) -> str:
    """SQL for the hex bytes of a text after lossy decoding."""
    sql = rf"regexp_replace({hexed}, '(..)', ' \1', 'g')"
    for pattern, instead in _WELL_FORMED:
        sql = f"regexp_replace({sql}, '{pattern}', '{instead}', 'g')"
    return f"replace({sql}, '_', '')"


def escaped(text: str) -> str:
    """SQL for a text with its control characters escaped."""
    shown = r"CASE WHEN regexp_full_match(c, '\p{C}|\n') THEN '\u' || lower(printf('%04X', ord(c))) ELSE c END"
    return f"list_aggregate(list_transform(string_split({text}, ''), lambda c: {shown}), 'string_agg', '')"
