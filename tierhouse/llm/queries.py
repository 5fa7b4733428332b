"""Registered queries: each operator on its whole table with production parameters."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from . import (bpe, conversation_repair, cover_tree, decontamination, language_id, line_dedup, merkle, near_dedup,
               posting_lists, sharding, surrogates, toxicity, url_filter)
from .common import ascii_lower
from .registry import query, table

SHARDS = 16
HELD_OUT_LANGUAGE, HELD_OUT_TOXICITY = 5, 4
# Fixed values of the task: verdict, host, start of the path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)



def tokenizer_path() -> str:
    """The word-level BPE vocabulary among the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


LINE_DEDUP_SQL = f"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i
  FROM parts WHERE trim(line, ' ') <> ''
), runs AS (
  SELECT f.doc_id, f.i, n, list(line) OVER w AS content, sum(length(line)) OVER w AS chars, count(*) OVER w AS held
  FROM filled f, range(1, {line_dedup.MIN_LINES + 1}) AS r(n)
  WINDOW w AS (PARTITION BY f.doc_id, n ORDER BY f.i ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS k
  FROM runs WHERE held = n AND (n = {line_dedup.MIN_LINES} OR chars >= {line_dedup.MIN_CHARS})
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS i FROM ranked WHERE k > 1
), rest AS (
  SELECT p.doc_id, string_agg(CASE WHEN g.i IS NULL THEN p.line END, chr(10) ORDER BY p.pos) AS kept,
    count(*) AS n_lines, count(g.i) AS n_removed
  FROM parts p LEFT JOIN filled f ON p.doc_id = f.doc_id AND p.pos = f.pos
    LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.i = g.i
  GROUP BY p.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.kept, '') END AS text,
  coalesce(r.n_lines, 0)::INTEGER AS n_lines, coalesce(r.n_removed, 0)::INTEGER AS n_removed
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id
"""


@query(LINE_DEDUP_SQL)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


def _remainder(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(_remainder(HELD_OUT_TOXICITY) == 2, F.lit(False))
    labels = table(spark, folder, "labels").filter(~held_out)
    docs = table(spark, folder, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return toxicity.score_toxicity(docs, labels.select("doc_id", F.col("toxic").alias("label")))


@query()
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(_remainder(HELD_OUT_LANGUAGE) == 0, F.lit(False))
    learned = language_id.fit(docs.filter(~held_out & F.col("lang").isNotNull()), "text", "lang")
    told = learned.predict(docs.select("doc_id", "text", held_out.alias("held_out")), "text")
    return told.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query()
def op5_bpe(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    codec = bpe.Codec(spark, tokenizer or tokenizer_path())
    docs = table(spark, folder, "documents")
    coded = docs.select("doc_id", codec.encode_and_decode(F.col("text")).alias("coded"))
    both = coded.select("doc_id", "coded.*")
    return both.select("doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query()
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Law: rows. The numbers of rows of any two shards differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    dealt = sharding.shuffle_into_shards(rows, SHARDS, seed=6)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@query()
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "verdict_by")


NEAR_DEDUP_SQL = """
WITH RECURSIVE parts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) = 1 THEN [[w[1]]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) END AS s
  FROM parts
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80
  GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common WHERE 100 * c >= 80 * (nx + ny - c)
  UNION ALL SELECT y, x FROM common WHERE 100 * c >= 80 * (nx + ny - c)
), reach AS (
  SELECT DISTINCT x, x AS y FROM links
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), least AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(y, doc_id) AS component_id, coalesce(y, doc_id) = doc_id AS kept
FROM sets LEFT JOIN least ON doc_id = x
"""


@query(NEAR_DEDUP_SQL)
def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Two-word shingles, as the contract of the query has it."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, width=2).select("doc_id", "n_shingles", "component_id", "kept")


DECONTAMINATION_SQL = """
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), parts AS (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w
  FROM texts
), sets AS (
  SELECT kind, id, CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) END AS s
  FROM parts
), items AS (
  SELECT kind, id, len(s) AS n, unnest(s) AS item FROM sets
)
SELECT d.id AS doc_id, i.id AS item_id, any_value(i.n)::INTEGER AS n_item, count(*)::INTEGER AS n_common
FROM items d JOIN items i ON d.item = i.item AND d.kind = 'd' AND i.kind = 'i'
GROUP BY 1, 2 HAVING count(*) * 100 >= any_value(i.n) * 80
"""


@query(DECONTAMINATION_SQL)
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.contained_items(docs, table(spark, folder, "benchmark"))


@query()
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.pseudonymize(docs, "a key of the query")


TOP_K_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place, vec_id, score
  FROM pairs
)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


@query(TOP_K_SQL)
def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Queries: vectors whose id is divisible by 50. Components become floor(256 * x)."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.when(whole, F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)))
    vectors = table(spark, folder, "embeddings").select("vec_id", scaled.alias("vector"))
    return cover_tree.nearest(vectors, 5, F.col("vec_id") % 50 == 0)


MERKLE_LEVELS = 6  # of the SQL: groups of up to 16 ** 6 nodes


def _merkle_levels(name: str, first: str) -> str:
    """Common tables ``{name}0`` to ``{name}6``: the nodes per level, a single one is carried on as it is."""
    steps = [f"{name}0 AS ({first})"]
    for i in range(MERKLE_LEVELS):
        steps.append(f"""{name}{i + 1} AS (
  SELECT g, r // 16 AS r, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY r)) END AS h,
    (any_value(n) + 15) // 16 AS n, string_agg(h, '' ORDER BY r) AS joined, any_value(n) > 1 AS hashed
  FROM {name}{i} GROUP BY g, r // 16)""")
    return ",\n".join(steps)


def _merkle_fold(name: str, first: str) -> str:
    """Common tables that fold the column ``f`` of ``first`` upwards along the path of each row, and gather the siblings."""
    steps, before = [], first
    for i in range(MERKLE_LEVELS):
        spot = f"(d.r // {16**i} % 16)"
        steps.append(f"""{name}_up{i + 1} AS (
  SELECT d.* REPLACE (CASE WHEN a.hashed THEN sha256(concat(substr(a.joined, 1, 64 * {spot}), d.f,
      substr(a.joined, 64 * {spot} + 65))) ELSE d.f END AS f,
    CASE WHEN a.hashed THEN concat(d.p, substr(a.joined, 1, 64 * {spot}), substr(a.joined, 64 * {spot} + 65)) ELSE d.p END AS p)
  FROM {before} d JOIN {name}{i + 1} a ON d.g IS NOT DISTINCT FROM a.g AND d.r // {16 ** (i + 1)} = a.r)""")
        before = f"{name}_up{i + 1}"
    return ",\n".join(steps)


def _leaf_sql(text: str) -> str:
    parts = ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(octet_length(encode({c}::VARCHAR)), ':', {c}::VARCHAR) END"
        for c in ("doc_id", "source", "lang", "n_chars", text)
    )
    return f"sha256(concat({parts}))"


CRC_TABLE_SQL = """SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)
    ORDER BY n) AS t FROM range(256) AS r(n)"""


def crc_sql(text: str) -> str:
    """CRC-32 of ASCII text by the table column ``t`` of ``CRC_TABLE_SQL``."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"


MERKLE_SQL = f"""
WITH crc_table AS ({CRC_TABLE_SQL}),
leaves AS (
  SELECT doc_id, source AS g, {_leaf_sql('text')} AS leaf, CASE WHEN {crc_sql('doc_id::VARCHAR')} % 5 = 0
    THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
    ELSE {_leaf_sql('text')} END AS f
  FROM documents, crc_table
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY g) AS n,
    '' AS p
  FROM leaves
), {_merkle_levels('rows', 'SELECT g, r, leaf AS h, n FROM ranked')},
{_merkle_fold('rows', 'ranked')},
subroots AS (
  SELECT 0 AS g, g AS source, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS r, count(*) OVER () AS n
  FROM rows{MERKLE_LEVELS}
), {_merkle_levels('tops', 'SELECT g, r, subroot AS h, n FROM subroots')},
paths AS (
  SELECT 0 AS g, s.r, d.doc_id, d.leaf, s.subroot, d.f, d.p
  FROM rows_up{MERKLE_LEVELS} d JOIN subroots s ON d.g IS NOT DISTINCT FROM s.source
), {_merkle_fold('tops', 'paths')}
SELECT doc_id, leaf, subroot, h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = h AS verified
FROM tops_up{MERKLE_LEVELS} JOIN (SELECT h FROM tops{MERKLE_LEVELS}) ON true
"""


@query(MERKLE_SQL)
def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of all documents, and what the proofs say of texts a fifth of which was lower-cased."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, folder, "documents").select(*columns)
    altered = merkle.digest_of([*map(F.col, columns[:-1]), ascii_lower(F.col("text"))])
    tampered = F.when(_remainder(5) == 0, altered)
    rows = merkle.manifest(docs, columns, "source", "doc_id", {"tampered": tampered})
    end = merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        end.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _form_sql() -> tuple[str, str, str]:
    """Rows of the form's tables: states with insertions before a row, edits of a row, ends."""
    r = conversation_repair
    moves, edits = [], []
    for state in range(4):
        now, roles = state, []
        for k in range(3):
            lines = ", ".join(f"'{x}:'" for x in roles)
            moves.append(f"({state}, {now}, {r.INSERT * k}, '{'I' * k}', [{lines}]::VARCHAR[])")
            roles.append("user" if r.ADDED[now] == "u" else "assistant")
            now = r.AFTER[now, r.ADDED[now]]
        edits.append(f"({state}, {state}, 'D', {r.DELETE}, NULL, NULL)")
        role = r.ADDED[state]
        edits.append(f"({state}, {r.AFTER[state, role]}, 'R', {r.REROLE}, NULL, '{'user' if role == 'u' else 'assistant'}')")
        edits += [f"({state}, {end}, 'K', 0, '{c}', NULL)" for (s, c), end in r.AFTER.items() if s == state]
    ends = []
    for state in range(4):
        lines = ", ".join("'user:'" if c == "u" else "'assistant:'" for c in r.FINISH[state][1::2])
        ends.append(f"({state}, {r.FINISH_COST[state]}, '{r.FINISH[state][::2]}', [{lines}]::VARCHAR[])")
    return ", ".join(moves), ", ".join(edits), ", ".join(ends)


_MOVES, _EDITS, _ENDS = _form_sql()
CONVERSATION_SQL = f"""
WITH RECURSIVE crc_table AS ({CRC_TABLE_SQL}),
moves(s, mid, cost, letters, added) AS (VALUES {_MOVES}),
edits(mid, s, letter, cost, initial, given) AS (VALUES {_EDITS}),
ends(s, cost, letters, added) AS (VALUES {_ENDS}),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      {crc_sql("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS h
    FROM conversations, crc_table)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(concat(octet_length(encode(role)), ':', role, text)), copy) AS i,
    substr(role, 1, 1) AS c, rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS body
  FROM damaged
), told AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1
      THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair
  FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    max(i) AS n
  FROM told GROUP BY conv_id
), best AS (
  SELECT conv_id, n AS i, s, {{'cost': cost, 'audit': letters, 'lines': added}} AS b FROM counted, ends
  UNION ALL
  SELECT t.conv_id, t.i - 1, m.s, min({{
    'cost': m.cost + e.cost + CASE WHEN e.letter <> 'D' AND t.fault = 'truncated' THEN {conversation_repair.TRUNCATED} ELSE 0 END + b.b.cost,
    'audit': concat(m.letters, e.letter, b.b.audit),
    'lines': list_concat(m.added, CASE WHEN e.letter = 'D' THEN []::VARCHAR[] ELSE [concat(coalesce(e.given, t.role), ':', t.text)] END,
      b.b.lines)}})
  FROM best b JOIN told t ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND b.i = t.i JOIN edits e ON e.s = b.s
    AND (e.initial IS NULL OR e.initial = t.c) AND (e.letter = 'D' OR t.fault NOT IN ('blank', 'duplicate'))
    JOIN moves m ON m.mid = e.mid
  GROUP BY t.conv_id, t.i, m.s
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.b.cost, 0)::BIGINT AS cost,
  coalesce(b.b.audit, '') AS audit, sha256(coalesce(array_to_string(b.b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN counted c ON d.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN best b ON d.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = 0 AND b.s = 0
"""


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """Conversations with known faults, by a checksum of id and turn (NULLs count as one space)."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    copies = F.when(h == 0, 0).when(h == 3, 2).otherwise(1)
    changed = F.when(h == 1, "").when(h == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    return rows.select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(text("role")).alias("role"), changed.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


@query(CONVERSATION_SQL)
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    fixed = conversation_repair.repair(damaged_conversations(rows), rows.select("conv_id"))
    report, digests = fixed.report().alias("r"), fixed.digests().alias("d")
    met = report.join(digests, F.col("r.conv_id").eqNullSafe(F.col("d.conv_id")))
    return met.select("r.*", F.col("d.sha256").alias("repaired_sha256"))


@query()
def op12_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """Queries: vectors whose id is divisible by 20."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return posting_lists.nearest(vectors, 20, F.col("vec_id") % 20 == 0)
