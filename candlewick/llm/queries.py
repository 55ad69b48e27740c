"""Registered queries of the training-data operators; keys are ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (chat_schema, decontaminate, gumbel_segmentation, html_crf, language_backoff, line_dedup,
                            merkle_manifest, multiset_hash, pii_bootstrap, quality_rules, simhash_bktree,
                            spelling_variants, warc_normaliser)
from candlewick.llm.common import held_out, prepare, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        wrapped.__name__, wrapped.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = wrapped
        return wrapped
    return deco


@register("op1_simhash_bktree")
def op1(spark, sf_dir):
    """SimHash components of all documents (4-word shingles, 4 bits)."""
    got = simhash_bktree.near_duplicates(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash_bktree.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                      "component_id")


@register("op4_quality_rules")
def op4(spark, sf_dir):
    """Quality score of all documents; the model learns from labelled rows that aren't held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.classify(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@register("op9_rare_seed_alignment")
def op9(spark, sf_dir):
    """Documents that hold a benchmark item, copied, edited or paraphrased, with its score."""
    return decontaminate.contaminated_pairs(read_table(spark, sf_dir, "documents"),
                                            read_table(spark, sf_dir, "benchmark"))


@register("op5_pii_bootstrap")
def op5(spark, sf_dir):
    """Base personal data of all documents, and the identifiers their contexts lead to."""
    got = pii_bootstrap.personal_data(read_table(spark, sf_dir, "documents"))
    return got.select(
        "doc_id", *[F.get("n", F.lit(i)).alias(f"n_{k}") for i, k in enumerate(pii_bootstrap.KINDS)],
        F.sha2(F.array_join("base", ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"))


@register("op2_gumbel_segmentation")
def op2(spark, sf_dir):
    """Two distinct sampled segmentations of every whole text, with inclusion scores and ids."""
    return gumbel_segmentation.sample_segmentations(
        read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@register("op7_multiset_hash")
def op7(spark, sf_dir):
    """Multiset fingerprints of all documents and of their edited texts."""
    return multiset_hash.edited_documents(read_table(spark, sf_dir, "documents"))


@register("op10_chat_schema")
def op10(spark, sf_dir):
    """All conversations, and one that says control strings, formatted and read back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.sql("SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
                    "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return chat_schema.conversations_digest(rows.unionByName(odd))


#: What the reading must give, from the rows alone: the template's own length is left to the query's
#: definition (markers, escapes), restated here in SQL.
ORACLE_SQL["op10_chat_schema"] = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(role) + length(text) + length(concat(role, text)) - length(replace(concat(role, text), '\', ''))
    + (length(concat(role, ' ', text)) - length(replace(concat(role, ' ', text), '<|', ''))) // 2
    + (length(concat(role, ' ', text)) - length(replace(concat(role, ' ', text), '<s>', ''))) // 3
    + (length(concat(role, ' ', text)) - length(replace(concat(role, ' ', text), '</s>', ''))) // 4
    + (length(concat(role, ' ', text)) - length(replace(concat(role, ' ', text), '[INST]', ''))) // 6
    + (length(concat(role, ' ', text)) - length(replace(concat(role, ' ', text), '[/INST]', ''))) // 7
    + (length(concat(role, ' ', text)) - length(replace(concat(role, ' ', text), '<<SYS>>', ''))) // 7
    + (length(concat(role, ' ', text)) - length(replace(concat(role, ' ', text), '<</SYS>>', ''))) // 8
    + 23 AS chars
  FROM rows_
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@register("op8_language_backoff")
def op8(spark, sf_dir):
    """Language of every whole text, by words first and character n-grams for unseen ones."""
    docs = read_table(spark, sf_dir, "documents")
    return language_backoff.predict(docs, language_backoff.fit(docs))


@register("op6_warc_normaliser")
def op6(spark, sf_dir):
    """All pages written to WARC archives, normalised to members, and read back by their offsets."""
    return warc_normaliser.archive_pages(read_table(spark, sf_dir, "pages"))


ORACLE_SQL["op6_warc_normaliser"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p
), least AS (
  SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest
)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN least.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN least.first <> d.page_id THEN least.first END AS refers_to
FROM d LEFT JOIN least ON d.digest = least.digest
"""


@register("op3_html_crf")
def op3(spark, sf_dir):
    """Main text of all pages by the block CRF."""
    pages = read_table(spark, sf_dir, "pages")
    return html_crf.main_text(pages, html_crf.fit(pages))


@register("op12_line_dedup")
def op12(spark, sf_dir):
    """Lines of at least 20 signs that 3 documents share, dropped from all but the last of them."""
    got = line_dedup.drop_shared_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op12_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, coalesce(k.doc_id < s.last, false) AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register("op13_merkle_manifest")
def op13(spark, sf_dir):
    """Merkle manifest of all documents, a version for every tampered leaf, and what its proof says."""
    return merkle_manifest.manifest(read_table(spark, sf_dir, "documents"))


#: crc32 by its table (polynomial 0xEDB88320), levels and folds by recursion.
ORACLE_SQL["op13_merkle_manifest"] = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS tbl FROM bits WHERE k = 8
), coded AS (
  SELECT doc_id, lang, n_chars,
    concat(coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-'),
           coalesce(octet_length(encode(source)) || ':' || source, '-'),
           coalesce(octet_length(encode(lang)) || ':' || lang, '-')) AS a,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS z,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
          list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda s, x: xor(s >> 8, tbl[(xor(s, x) & 255) + 1])), 4294967295) % 7 = 0 AS odd
  FROM documents, crc
), leaves AS (
  SELECT doc_id, lang,
    sha256(concat(a, coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'), z)) AS leaf,
    CASE WHEN odd THEN sha256(concat(a, coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-'), z)) END AS fake,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM coded
), tree(lang, level, pos, n, h) AS (
  SELECT lang, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1
  GROUP BY lang, level, pos // 2, n
), subroots AS (
  SELECT lang, level AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM tree WHERE n = 1
), top(level, pos, n, h) AS (
  SELECT 0, place, n, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1
  GROUP BY level, pos // 2, n
), all_nodes AS (
  SELECT lang, level, pos, h FROM tree WHERE n > 1
  UNION ALL
  SELECT s.lang, s.height + t.level, t.pos, t.h FROM top t, subroots s WHERE t.n > 1
), steps AS (
  SELECT l.lang, l.pos AS leaf_pos, g.i AS level,
    CASE WHEN g.i < s.height THEN l.pos >> g.i ELSE s.place >> (g.i - s.height) END AS at,
    s.height + (SELECT max(level) FROM top) AS height
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, range(64) g(i)
  WHERE g.i < s.height + (SELECT max(level) FROM top)
), siblings AS (
  SELECT p.lang, p.leaf_pos, p.level, p.at % 2 = 1 AS is_right, n.h
  FROM steps p LEFT JOIN all_nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.level = p.level AND n.pos = xor(p.at, 1)
), proofs AS (
  SELECT lang, leaf_pos, string_agg(h, '' ORDER BY level) AS proof FROM siblings GROUP BY lang, leaf_pos
), folds(lang, leaf_pos, level, h) AS (
  SELECT lang, pos, 0, coalesce(fake, leaf) FROM leaves
  UNION ALL
  SELECT f.lang, f.leaf_pos, f.level + 1,
    sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.is_right THEN s.h || f.h ELSE f.h || s.h END)
  FROM folds f JOIN siblings s ON f.lang IS NOT DISTINCT FROM s.lang AND f.leaf_pos = s.leaf_pos AND f.level = s.level
), folded AS (
  SELECT lang, leaf_pos, arg_max(h, level) AS h FROM folds GROUP BY lang, leaf_pos
), root AS (
  SELECT h FROM top WHERE n = 1
)
SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
  f.h AS folded_root, f.h = root.h AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.leaf_pos = l.pos
JOIN folded f ON f.lang IS NOT DISTINCT FROM l.lang AND f.leaf_pos = l.pos, root
"""


@register("op11_vgram_variants")
def op11(spark, sf_dir):
    """Words of all documents, each with the more frequent word that it is a spelling variant of."""
    return spelling_variants.spelling_variants(read_table(spark, sf_dir, "documents"))


#: Near words by their deletions (equal after deleting one place, or a word and another's deletion); crc32 by table.
ORACLE_SQL["op11_vgram_variants"] = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS tbl FROM bits WHERE k = 8
), found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
        string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
                  ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))),
      lambda s, x: xor(s >> 8, tbl[(xor(s, x) & 255) + 1])), 4294967295) AS h
  FROM counted, crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), cut AS (
  SELECT word, n, unnest(range(length(word))) AS i, left(word, i) || substr(word, i + 2) AS less FROM words
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS m FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    AND length(a.word) = length(b.word)
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.less = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.less = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM pairs GROUP BY word
), named AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.m >= 2 * w.n THEN (SELECT min(p.near) FROM pairs p WHERE p.word = w.word AND p.m = b.m) END AS form,
    CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), chain(word, tip, step) AS (
  SELECT word, word, 0 FROM named
  UNION ALL SELECT c.word, n.form, step + 1 FROM chain c JOIN named n ON c.tip = n.word WHERE n.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(tip, step) AS root FROM chain GROUP BY word
)
SELECT n.word, n.form, r.root, n.n, CAST(n.n_near AS BIGINT) AS n_near, n.form_n
FROM named n JOIN roots r ON n.word = r.word
"""
