"""The registered queries of this subpackage, with SQL counterparts where SQL can express them.

Each applies one operator to its whole table and returns what the operator made, texts as
digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.byte_bpe import encode
from daybook.llm.chat_format import format_chat, read_chat
from daybook.llm.decontamination import leaks
from daybook.llm.hard_negatives import hard_negatives
from daybook.llm.html_text import html_text
from daybook.llm.line_dedup import line_dedup
from daybook.llm.minhash_dedup import near_duplicates
from daybook.llm.quality_rules import COUNTS, quality_rules
from daybook.llm.ranked_search import ranked_search
from daybook.llm.rows import stored
from daybook.llm.substring_dedup import substring_dedup
from daybook.llm.suffix_dedup import suffix_dedup
from daybook.llm.url_filter import Rule, labelled, url_filter
from daybook.llm.warc import dangling, page_id, read_warc, write_warc
from daybook.session import scratch_dir

TOKENIZER = "byte_bpe_multi_50k.tiktoken"

URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]
#: A conversation whose texts hold the template's own marks.
HARD_TEXT = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _digest(column: str):
    return F.sha2(F.coalesce(F.col(column), F.lit("")).cast("binary"), 256)


def op1_line_dedup(spark, sf_dir):
    return line_dedup(_texts(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", _digest("text").alias("kept_sha256")
    )


def op2_substring_dedup(spark, sf_dir):
    return substring_dedup(_texts(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", _digest("text").alias("kept_sha256")
    )


def op3_html_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text(pages).select("page_id", "url", "text", "n_chars")


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup(_texts(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_quality_rules(spark, sf_dir):
    judged = quality_rules(_texts(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")


def op6_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path(TOKENIZER)
    texts = _texts(spark, sf_dir)
    return encode(texts, path, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_minhash_dedup(spark, sf_dir):
    return near_duplicates(_texts(spark, sf_dir)).drop("key")


def op8_url_filter(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter(pages, URL_RULES, labelled(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_decontamination(spark, sf_dir):
    return leaks(_texts(spark, sf_dir), _table(spark, sf_dir, "benchmark")).drop("key")


def op10_chat_format(spark, sf_dir):
    hard = spark.createDataFrame(
        [(-1, 0, "user", HARD_TEXT), (-1, 1, "assistant", HARD_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    line = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    learnt = F.array_join("learnt", "")
    return read_chat(format_chat(given.unionByName(hard))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_warc(spark, sf_dir):
    """All pages written as archives and read back; every revisit must refer to a record that was read."""
    path = f"{scratch_dir(spark)}/archives"
    write_warc(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    records = stored(read_warc(spark, path, payloads=False).where("record_type in ('response', 'revisit')"))
    if not dangling(records).isEmpty():
        raise ValueError("a revisit refers to a payload that is not in the archives")
    return records.select(
        page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id("refers_to").alias("refers_to"),
    )


def op12_ranked_search(spark, sf_dir):
    items = _table(spark, sf_dir, "benchmark").select("item_id", "text")
    return ranked_search(_texts(spark, sf_dir), items).select("item_id", "rank", "doc_id", "score")


def op13_hard_negatives(spark, sf_dir):
    """Every seventh label is moved on by one, so that labels and vectors disagree there."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    query.__name__: query
    for query in (
        op1_line_dedup,
        op2_substring_dedup,
        op3_html_text,
        op4_suffix_dedup,
        op5_quality_rules,
        op6_byte_bpe,
        op7_minhash_dedup,
        op8_url_filter,
        op9_decontamination,
        op10_chat_format,
        op11_warc,
        op12_ranked_search,
        op13_hard_negatives,
    )
}

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL = {
    "op1_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS number
  FROM documents WHERE text IS NOT NULL
),
spoken AS (
  SELECT doc_id, number, line, row_number() OVER (PARTITION BY doc_id ORDER BY number) AS place
  FROM lines WHERE trim(line, {_SPACE}) <> ''
),
windows AS (
  SELECT a.doc_id, a.place, a.number AS n0, b.number AS n1, c.number AS n2,
         row_number() OVER (PARTITION BY a.line, b.line, c.line ORDER BY a.doc_id, a.place) AS nth
  FROM spoken a
  JOIN spoken b ON b.doc_id = a.doc_id AND b.place = a.place + 1
  JOIN spoken c ON c.doc_id = a.doc_id AND c.place = a.place + 2
),
gone AS (
  SELECT DISTINCT doc_id, unnest([n0, n1, n2]) AS number FROM windows WHERE nth > 1
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN (
  SELECT l.doc_id, count(*) AS n_lines, count(g.number) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY l.number) FILTER (WHERE g.number IS NULL) AS kept
  FROM lines l LEFT JOIN gone g USING (doc_id, number) GROUP BY l.doc_id
) k USING (doc_id)""",
    "op2_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT doc_id, start, w[start:start + 34] AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS start FROM words WHERE len(w) >= 35)
),
again AS (SELECT run FROM windows GROUP BY run HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 35)) AS place
  FROM windows SEMI JOIN again USING (run)
),
each AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words
),
kept AS (
  SELECT e.doc_id, count(g.place) AS n_removed,
         string_agg(e.word, ' ' ORDER BY e.place) FILTER (WHERE g.place IS NULL) AS kept
  FROM each e LEFT JOIN gone g USING (doc_id, place) GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)""",
    "op7_minhash_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[start:start + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS start
        FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY x, y
),
links AS (
  SELECT x, y FROM shared o JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * o.n >= 75 * (a.n + b.n - o.n)
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sizes
  UNION
  SELECT r.x, l.y FROM reach r
  JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON l.x = r.y
),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.y, w.doc_id) AS component_id,
       coalesce(l.y, w.doc_id) = w.doc_id AS kept
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.x = w.doc_id""",
    "op10_chat_format": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{HARD_TEXT}'
  UNION ALL SELECT -1, 1, 'assistant', '{HARD_TEXT}'
),
shown AS (
  SELECT *, regexp_matches(role || chr(10) || text, '<\|im_start\|>|<!+\|')
            OR contains(text, '<|im_end|>') OR contains(role, '<|nl|>') OR contains(role, chr(10))
            AS hard,
         len(regexp_extract_all(role || chr(10) || text, '<!*\|')) AS marks,
         len(role) - len(replace(role, chr(10), '')) AS breaks
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(len(role) + len(text) + 24
                + CASE WHEN hard THEN marks + 5 * breaks ELSE 0 END) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id""",
    "op11_warc": """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
),
described AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest
  FROM payloads
),
shared AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM described
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM shared""",
    "op12_ranked_search": r"""
WITH terms AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
totals AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM terms),
lengths AS (
  SELECT doc_id, w, 100 - 75 + (75 * CAST(len(w) AS BIGINT) * t.docs) // t.terms AS m
  FROM terms, totals t WHERE len(w) > 0
),
counted AS (
  SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(w) AS term FROM lengths)
  GROUP BY doc_id, m, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(t.docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals t GROUP BY term
),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
  GROUP BY item_id, term
),
scored AS (
  SELECT a.item_id, c.doc_id,
         CAST(sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * c.m))) AS BIGINT) AS score
  FROM asked a JOIN weights w USING (term) JOIN counted c USING (term)
  GROUP BY a.item_id, c.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10""",
    "op13_hard_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
}
