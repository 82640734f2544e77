"""The registered queries of this subpackage, and SQL for those that DuckDB can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER_COUNT = "byte_bpe_50k.json"
TOKENIZER_STORE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import drop_common_lines

    out = drop_common_lines(_table(spark, sf_dir, "documents"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    out = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "longest_item", "longest_at")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import Template, format_chat, read_chat, unescaped

    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    chats = format_chat(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))
    loss = F.filter("segments", lambda s: s["loss"])
    out = chats.select(
        "conv_id",
        "valid",
        "error_turn",
        read_chat(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(loss, lambda s: unescaped(s["text"], Template())), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
        "error_turn",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, tokenizer_path(TOKENIZER_COUNT), limit=1024)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .shared import new_path
    from .token_store import read_digests, write_tokens

    path = new_path(spark, "tokens")
    write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_path(TOKENIZER_STORE), end_id=2)
    return read_digests(spark, path)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_scores

    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), k=5, percent=85)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_main_text

    return extract_main_text(_table(spark, sf_dir, "pages"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import bpe_encoded

    out = bpe_encoded(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(TOKENIZER_STORE), decoded_col="decoded")
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0, positives=5, negatives=5, low_percent=80, high_percent=100)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import prefix_trie, sequences

    own = sequences(_table(spark, sf_dir, "conversations"))
    # the first h turns are those of the conversation that a group of twenty begins with
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    others = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("start"))
    both = own.withColumns({"h": h.cast("int"), "base": F.col("conv_id") - F.col("conv_id") % 20}).join(others, "base", "left")
    start = F.coalesce(F.slice("start", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return prefix_trie(both.select("conv_id", F.concat(start, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns")))


def queries() -> dict:
    ops = (op1_line_dedup, op2_decontamination, op3_chat_format, op4_source_mixing, op5_embedding_dedup, op6_token_counts, op7_quality, op8_minhash_dedup, op9_html_text, op10_token_store, op11_bpe, op12_hard_negatives, op13_prefix_trie)
    return {f.__name__: f for f in ops}


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT *, {_FOLD.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines
), often AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(o.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE o.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often o USING (k) GROUP BY doc_id
"""

_WORDS = "regexp_extract_all(" + _FOLD + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP2 = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), found AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, x)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id),
dw AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM d),
bw AS (SELECT item, generate_subscripts(w, 1) AS j, unnest(w) AS word, r FROM (SELECT item_id::VARCHAR AS item, w, row_number() OVER () AS r FROM b)),
runs AS (
  SELECT doc_id, item, min(i) - 1 AS begin_at, count(*) AS n
  FROM (SELECT doc_id, item, r, i, i - j AS g, i - row_number() OVER (PARTITION BY doc_id, r, i - j ORDER BY i) AS run FROM dw JOIN bw USING (word)) GROUP BY doc_id, item, r, g, run
), best AS (SELECT doc_id, n, begin_at, item FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, begin_at, item) = 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n, 0)::BIGINT AS longest, item AS longest_item, begin_at::BIGINT AS longest_at
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN best USING (doc_id)
"""

_CONTROL = r"(### System:|### User:|### Assistant:|</turn>)"
_OP3 = rf"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), parts AS (
  SELECT *, length('### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE '%:' || role END || ':' || chr(10))
    + length(regexp_replace(text, '(\\*){_CONTROL}', '\1\1\\\2', 'g')) + length(chr(10) || '</turn>' || chr(10)) AS chars
  FROM turns
), whole AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars,
    string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, '' ORDER BY turn, role, text) AS roles
  FROM parts GROUP BY conv_id
)
SELECT * EXCLUDE (roles, accepted), accepted = n_turns AND roles LIKE '%u%' AS valid, CASE WHEN accepted < n_turns OR roles NOT LIKE '%u%' THEN accepted END::INT AS error_turn
FROM (SELECT *, length(regexp_extract(roles, '^s?(ua)*u?')) AS accepted FROM whole)
"""

_OP4 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), keyed AS (
  SELECT *, -ln((('0x' || substr(md5(doc_id::VARCHAR || ':' || md5(t) || ':17'), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0)
    / ((1.0 + strlen(regexp_replace(t, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', '', 'g'))) / (1.0 + strlen(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')))) AS k
  FROM d
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source
), fill AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER o, 0.0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER o, 0.0) AS ws
  FROM src WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), opened AS (SELECT arg_min(rest, cap / w) AS rest0, arg_min(ws, cap / w) AS ws0 FROM fill WHERE rest * w / ws < cap),
targets AS (SELECT source, source_size, CASE WHEN rest * w / ws >= cap THEN cap ELSE rest0 * w / ws0 END AS target FROM fill, opened),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets),
picked AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs,
    (sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id) - k.size / 2.0::DOUBLE <= p.target - p.epochs * p.source_size) AS more
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target::DOUBLE AS target, CASE WHEN size > 0 THEN (epochs + more::INT) * size ELSE 0 END::BIGINT AS taken FROM picked
"""

_OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id)::BIGINT AS n_links, least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
  vec_id <= coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id) AS kept
FROM embeddings
"""

_OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_FOLD.format("text")}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM d)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""


_OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS s FROM v a JOIN v b ON a.vec_id % 100 = 0
), pos AS (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS r FROM scores WHERE same AND a <> b QUALIFY r <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b))::INT AS rank, n.b AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM pos p JOIN scores n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s QUALIFY rank <= 5
"""

_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({0}) + 1),
  lambda i: list_transform(range(0, 8), lambda b: ((ascii({0}[i]) >> b::INT) & 1)::BIGINT)))),
  lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384::BIGINT) ELSE xor(c, b) >> 1 END))"""

_OP13 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS s FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'s': s, 'w': len(regexp_extract_all(text, '[^ 	-
]+'))::BIGINT}} ORDER BY turn NULLS FIRST, role, s) AS l FROM t GROUP BY conv_id
), h AS (SELECT *, ({_CRC.format("(conv_id::VARCHAR)")} % 4)::INT AS h FROM own),
rebuilt AS (SELECT h.conv_id, list_concat(coalesce(b.l, [])[1:h], h.l[h + 1:]) AS l FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
prefixes AS (
  SELECT conv_id, d, array_to_string(list_transform(l[1:d], lambda x: x.s), '') AS p, coalesce(l[d].w, 0) AS w, d = len(l) AS ends FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM prefixes GROUP BY d, p
), children AS (SELECT d - 1 AS d, left(p, 32 * (d::INT - 1)) AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN children USING (d, p)),
sums AS (
  SELECT a AS d, left(p, 32 * a::INT) AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * w END) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_node) GROUP BY 1, 2
)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_node n JOIN sums USING (d, p) LEFT JOIN node up ON up.d = n.d - 1 AND n.d > 0 AND up.p = left(n.p, 32 * (n.d::INT - 1))
"""


def oracle_sql() -> dict[str, str]:
    """Tokenizers, the classifier, page trees and compressed files have no SQL; tests hold them against brute force."""
    return {"op1_line_dedup": _OP1, "op2_decontamination": _OP2, "op3_chat_format": _OP3, "op4_source_mixing": _OP4, "op5_embedding_dedup": _OP5, "op8_minhash_dedup": _OP8, "op12_hard_negatives": _OP12, "op13_prefix_trie": _OP13}
