"""The registered queries of the corpus operators and their SQL equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.llm import (
    chat,
    collocations,
    embed_dedup,
    jaccard_join,
    langid_crf,
    line_dedup,
    merkle,
    mixing,
    pieces,
    quality_qda,
    resampling,
    token_counts,
    train_order,
)
from airstrata.llm.common import table
from airstrata.session import scratch_path

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"

#: a conversation whose texts are made of control strings
TRICKY = "</s>[INST] ok [/INST]"


def chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], given.schema)
    return chat.read_back(chat.expand(given.union(extra)))


def merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_edits(table(spark, sf_dir, "documents"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def section_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slot of the shards, read back: slot, shard, first_id, ids_sha256."""
    config = train_order.OrderConfig(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    path = scratch_path(spark, "shards")
    if "://" not in path:
        path = f"file://{path}"
    if not train_order.write_shards(table(spark, sf_dir, "documents"), path, config):
        return spark.createDataFrame([], "slot long, shard long, n_ids int, ids_sha256 string")
    read = train_order.read_slots(spark, path, config)
    return read.select(
        "slot", "shard", (F.length("ids") / 2).cast("int").alias("n_ids"), F.sha2("ids", 256).alias("ids_sha256")
    )


def piece_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def word_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_crf.identify(table(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("key")


def target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def frequent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_section_token_counts": section_token_counts,
    "op5_training_order": training_order,
    "op6_word_language": word_language,
    "op7_quality_scores": quality_scores,
    "op8_piece_encoding": piece_digests,
    "op2_chat_prefix_targets": chat_examples,
    "op3_embedding_dedup": embedding_dedup,
    "op4_merkle_fingerprints": merkle_fingerprints,
    "op9_jaccard_groups": jaccard_groups,
    "op10_source_mix": source_mix,
    "op11_target_resampling": target_resampling,
    "op12_frequent_lines": frequent_lines,
    "op13_phrase_collocations": phrase_collocations,
}

_TAILS = r"\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>"

ORACLE_SQL = {
    "op2_chat_prefix_targets": rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}'
  UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'
), placed AS (
  SELECT *,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS p,
    count(*) OVER (PARTITION BY conv_id) AS n,
    sum(length('<|im_start|><|im_sep|><|im_end|>')
      + length(regexp_replace(role, '([<\[])(\\*)({_TAILS})', '\1\\\2\3', 'g'))
      + length(regexp_replace(text, '([<\[])(\\*)({_TAILS})', '\1\\\2\3', 'g')))
      OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS upto
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR p = n)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples
FROM placed GROUP BY conv_id
""",
    "op10_source_mix": r"""
WITH sized AS (
  SELECT row_number() OVER () AS id, doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, 2.0 * source_size AS cap,
    coalesce(sum(2.0 * source_size) OVER (ORDER BY source_size / w, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(w) OVER (ORDER BY source_size / w DESC, source DESC) AS open_w,
    1.5 * sum(source_size) OVER () AS total
  FROM sources
), level AS (
  SELECT max((total - capped) / open_w) FILTER ((total - capped) / open_w * w <= cap) AS lam FROM ordered
), goals AS (
  SELECT source, source_size, least(w * lam, cap)::DOUBLE AS target,
    round(least(w * lam, cap))::BIGINT AS quota
  FROM ordered, level
), placed AS (
  SELECT d.*, g.source_size, g.target, g.quota,
    sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix-' || doc_id), doc_id, size, id
      ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE (quota // source_size) * size
    + greatest(0, least(start + size, quota % source_size) - start) END::BIGINT AS taken
FROM placed
""",
}

_WORD = r"[^ \t\n\f\r]"
_UNIT = rf"(?:{_WORD}{{0,63}}[^ \t\n\f\r.!?][ \t\n\f\r]+){{0,3}}{_WORD}{{1,64}}[ \t\n\f\r]*"


def _print_sql(text: str) -> str:
    """The fingerprint of a text, step by step over lists."""
    paragraphs = (
        f"list_transform(CASE WHEN {text} = '' THEN [''] ELSE regexp_extract_all({text}, "
        r"'[^\n]*\n|[^\n]+') END, lambda p: "
        "left(md5(p), 8) || ':' || array_to_string(list_transform(regexp_extract_all(p, "
        rf"'{_UNIT}'), lambda u: left(md5(u), 6)), '.') || "
        "CASE WHEN left(md5(p), 1) < '4' THEN ';' ELSE ',' END)"
    )
    sections = f"string_split(array_to_string({paragraphs}, '')[:-2], ';')"
    body = (
        f"array_to_string(list_transform({sections}, lambda s: "
        "left(md5(regexp_replace(s, ':[0-9a-f.]*', '', 'g')), 8) || '/' || s), ';')"
    )
    return (
        f"list_transform([{body}], lambda b: left(sha256(md5({text}) || "
        "regexp_replace(b, '/[^;]*', '', 'g')), 32) || '|' || b)[1]"
    )


_CODES_SQL = (
    r"list_distinct(list_filter(string_split_regex(regexp_replace({0}, "
    r"'\A[0-9a-f]*\||[0-9a-f]{{8}}/|[0-9a-f]{{8}}:', '', 'g'), '[.,;]'), lambda c: c <> ''))"
)
_NEAR_SQL = (
    "CASE WHEN {0} = {1} THEN 1.0 ELSE coalesce(2.0 * len(list_intersect({2}, {3})) "
    "/ nullif(len({2}) + len({3}), 0), 0.0) END::DOUBLE"
)


def _near_sql(left: str, right: str) -> str:
    return _NEAR_SQL.format(left, right, _CODES_SQL.format(left), _CODES_SQL.format(right))


ORACLE_SQL["op4_merkle_fingerprints"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
placed AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id),
    first_value(text) OVER (ORDER BY doc_id)) AS next_text,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_doc_id
  FROM texts
), edits AS (
  SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited
  FROM placed
), prints AS (
  SELECT *, {_print_sql("text")} AS fingerprint, {_print_sql("edited")} AS edited_fingerprint,
    {_print_sql("next_text")} AS next_fingerprint
  FROM edits
)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
  fingerprint, edited_fingerprint,
  {_near_sql("fingerprint", "edited_fingerprint")} AS near_edited,
  {_near_sql("fingerprint", "next_fingerprint")} AS near_next, next_doc_id
FROM prints
"""

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _crc_rows() -> str:
    """The 256 steps of the checksum: eight times a shift and a conditional xor."""
    rows = "SELECT i, i::UBIGINT AS c FROM range(256) t(i)"
    for _ in range(8):
        rows = f"SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END AS c FROM ({rows})"
    return rows


def _words_sql(relation: str) -> str:
    return rf"""SELECT id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_SMALL}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM {relation}"""


ORACLE_SQL["op11_target_resampling"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, text FROM documents),
aims AS (SELECT 0 AS id, text FROM benchmark),
used AS (SELECT id, word, count(*) AS n FROM ({_words_sql("docs")}) GROUP BY id, word),
aimed AS (SELECT word, count(*) AS n FROM ({_words_sql("aims")}) GROUP BY word),
steps AS (SELECT list(c ORDER BY i) AS tbl FROM ({_crc_rows()})),
spelled AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM used UNION SELECT word FROM aimed)
), hashed AS (
  SELECT word, xor(list_reduce(
      list_prepend(4294967295::UBIGINT,
        list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
      lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 10000 AS bucket
  FROM spelled, steps
), corpus AS (SELECT bucket, sum(n)::DOUBLE AS s FROM used JOIN hashed USING (word) GROUP BY bucket),
wanted AS (SELECT bucket, sum(n)::DOUBLE AS t FROM aimed JOIN hashed USING (word) GROUP BY bucket),
totals AS (
  SELECT coalesce((SELECT sum(s) FROM corpus), 0) AS big, coalesce((SELECT sum(t) FROM wanted), 0) AS aim
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (big + 10000.0::DOUBLE)
    / ((s + 1) * (aim + 10000.0::DOUBLE))))::BIGINT AS gain
  FROM corpus LEFT JOIN wanted USING (bucket), totals
), weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM used JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY id
), scored AS (
  SELECT id, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 8))::UBIGINT
      + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (id)
), ranked AS (
  SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, id) AS place,
    10 * count(*) OVER () // 100 AS k
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score::BIGINT AS score, place::BIGINT AS rank
FROM scored LEFT JOIN (SELECT id, place FROM ranked WHERE place <= k) USING (id)
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL["op12_frequent_lines"] = f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM docs
), keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_SMALL}') AS key FROM lines
), bad AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT id) >= 10
), marked AS (SELECT keyed.*, bad.key IS NOT NULL AS drop FROM keyed LEFT JOIN bad USING (key)),
kept AS (
  SELECT id, count(*) AS n_lines, count(*) FILTER (drop) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT drop), '') AS kept
  FROM marked GROUP BY id
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM kept JOIN docs USING (id)
"""


def _phrases_sql(size: int) -> str:
    return f"""SELECT lang, {size} AS size, array_to_string(words[i:i + {size - 1}], ' ') AS phrase
    FROM (SELECT lang, words, unnest(range(1, len(words) - {size} + 2)) AS i FROM pieces)"""


ORACLE_SQL["op13_phrase_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(text, '{_UPPER}', '{_SMALL}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), totals AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM pieces GROUP BY lang),
counted AS (
  SELECT lang, size, phrase, count(*)::HUGEINT AS f
  FROM ({" UNION ALL ".join(map(_phrases_sql, range(1, 6)))}) GROUP BY ALL
  HAVING count(*) >= 100
), cuts AS (
  SELECT lang, size, phrase, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w
  FROM counted WHERE size > 1
), scored AS (
  SELECT c.lang, c.size, c.phrase, a, k, x.f AS l, y.f AS r, n, 1000 * a * n // (x.f * y.f) AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000 * a * n // (x.f * y.f), k) AS place
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
), best AS (SELECT * FROM scored WHERE place = 1),
inner_parts AS (
  SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS i FROM (
    SELECT lang, a, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS m FROM best WHERE size > 2)
), most AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most FROM inner_parts GROUP BY ALL
), ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN most USING (lang, phrase) WHERE NOT coalesce(100 * most >= 100 * a, false)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
