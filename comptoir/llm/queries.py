"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm import align, archives, block_knn, bpe, chat, hamming_join, importance, merkle, ngram_join, packing, quality_rules, suffix_dedup, templates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


_STEP = 500
"""Windows of a part of a text: a part is cut out once, its windows from the part."""
_OP1_SQL = f"""
WITH body AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS doc, doc_id,
           hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), parts AS (
    SELECT doc, n, p, substr(h, 2 * p + 1, {2 * (_STEP + suffix_dedup.LENGTH - 1)}) AS h
    FROM (SELECT doc, h, n, unnest(range(0, n - {suffix_dedup.LENGTH - 1}, {_STEP})) AS p FROM body)
), windows AS (
    SELECT doc, p + j AS i, unhex(substr(h, 2 * j + 1, {2 * suffix_dedup.LENGTH})) AS s
    FROM (SELECT doc, p, h, unnest(range(0, least({_STEP}, n - {suffix_dedup.LENGTH - 1} - p))) AS j FROM parts)
), repeated AS (
    SELECT doc, i FROM (SELECT doc, i, row_number() OVER (PARTITION BY s ORDER BY doc, i) AS k FROM windows) WHERE k > 1
), turns AS (
    SELECT doc, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc ORDER BY i) + {suffix_dedup.LENGTH} THEN 0 ELSE 1 END AS turn FROM repeated
), runs AS (
    SELECT doc, min(i) AS a, max(i) + {suffix_dedup.LENGTH} AS b
    FROM (SELECT doc, i, sum(turn) OVER (PARTITION BY doc ORDER BY i) AS run FROM turns) GROUP BY doc, run
), kept AS (
    SELECT doc, coalesce(lag(b) OVER (PARTITION BY doc ORDER BY a), 0) AS a, a AS b, b - a AS gone FROM runs
    UNION ALL SELECT doc, coalesce(last, 0), n, 0 FROM body LEFT JOIN (SELECT doc, max(b) AS last FROM runs GROUP BY doc) USING (doc)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(sum(gone) AS BIGINT) AS n_removed, count(*) FILTER (gone > 0) AS n_spans,
       sha256(unhex(string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b))) AS kept_sha256
FROM kept JOIN body USING (doc) GROUP BY doc, doc_id, n"""


def op2_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def _op5_sql(columns: str = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept") -> str:
    broken = quality_rules.rules_sql()
    stops = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    return f"""
WITH body AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), marks AS (
    SELECT doc_id, w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2] AS three, i
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM body)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM marks) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id
), lines AS (
    SELECT doc_id, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM body
), counts AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS BIGINT) AS n_stop_words
    FROM body JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *, {' OR '.join(broken[n] for n in quality_rules.BASE)} AS base_failed,
           NOT ({' OR '.join(broken.values())}) AS kept
    FROM counts
)
SELECT {columns} FROM judged"""


def conversation_log(rows: DataFrame) -> DataFrame:
    """Each row as the events that a chat server would log: a start, then its text in two deltas.

    By a hash, a fifth of the messages are drafts that are generated anew, a fifth say something else until they are
    edited, a fifth begin in another role and are started again, and beside a fifth stands a message that is deleted.
    Rows that share conversation and turn stand in the order of a hash of role and text; equal rows are
    counted first and written as often as they occur.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.groupBy("conv_id", "turn", role.alias("role"), text.alias("text")).count().select(
        "conv_id", "turn", F.xxhash64("role", "text").alias("tie"), "role", "text",
        F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("copy"),
    )
    half = (F.length("text") / 2).cast("int")
    own, other = F.col("role"), F.concat(F.lit("not "), "role")

    def event(seq: int, kind: str, part: Column, who: Column = own, copy: Column | None = None) -> Column:
        place = F.col("copy") if copy is None else copy
        return F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), part.alias("text"), who.alias("role"), place.alias("copy"))

    none, wrong = F.lit(""), F.concat(F.lit("draft of "), "text")
    said = [event(5, "delta", F.substring("text", F.lit(1), half)), event(6, "delta", F.substring("text", half + 1, F.length("text")))]
    beside = -F.col("copy")
    kind = F.pmod(F.xxhash64("tie", "conv_id"), F.lit(5))
    events = (
        F.when(kind == 0, F.array(event(0, "start", none), event(1, "delta", wrong), event(2, "regenerate", none), *said))
        .when(kind == 1, F.array(event(0, "start", none), event(1, "delta", wrong), event(7, "edit", F.col("text"))))
        .when(kind == 2, F.array(event(0, "start", none, other), event(1, "delta", wrong, other), event(2, "start", none), *said))
        .when(kind == 3, F.array(event(0, "start", none), *said, event(0, "start", none, own, beside), event(1, "delta", wrong, own, beside), event(2, "delete", none, own, beside)))
        .otherwise(F.array(event(0, "start", none), *said))
    )
    return turns.withColumn("events", events).select("conv_id", "turn", "tie", F.inline("events"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = f"{chat.END}{chat.START}assistant ok"
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.inline(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(control).alias("text")) for i, r in enumerate(("user", "assistant"))])),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    order = ("turn", "tie", "copy")
    rendered = chat.render(chat.fold_events(conversation_log(rows), message=order))
    return chat.read_back(rendered, order=order)


_ESCAPED = r"regexp_replace({0}, '<(\\*)(n?)\|', '<\\\1\2|', 'g')"

_OP6_SQL = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t, r, '{chat.END}{chat.START}assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(chat.START) + len(chat.END) + 2} + length(replace({_ESCAPED.format('role')}, chr(10), '<n|')) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""


def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.convert(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_OP7_SQL = f"""
WITH p AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {archives.LEAST_SHARED} AND page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {archives.LEAST_SHARED} AND page_id < kept THEN kept END AS refers_to
FROM k"""


def op8_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_knn.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


_OP8_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score FROM pairs
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 20"""


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


_OP9_SQL = f"""
WITH RECURSIVE body AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), grams AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < {ngram_join.WORDS} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {ngram_join.WORDS - 1}], ' ') END AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {ngram_join.WORDS - 2}, 2))) AS i FROM body WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
both_ways AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams AS a JOIN grams AS b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b, j.n = x.n AND j.n = y.n AS same FROM both_ways AS j JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 10 * j.n >= 8 * (x.n + y.n - j.n)
), reach AS (
    SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.r
), class AS (SELECT d, min(r) AS class_id FROM reach GROUP BY d),
counted AS (SELECT a, count(*) AS n_links, min(b) FILTER (same) AS copy FROM links GROUP BY a)
SELECT d AS doc_id, class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, least(d, coalesce(copy, d)) AS rep_id
FROM class LEFT JOIN counted ON a = d"""


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def _hash_sql(text: str) -> str:
    fields = [*merkle.FIELDS[:-1], text]
    told = " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE octet_length(encode(CAST({f} AS VARCHAR))) || ':' || {f} END" for f in fields)
    return f"sha256({told})"


_OP11_SQL = f"""
WITH RECURSIVE told AS (
    SELECT doc_id, lang, text, {_hash_sql('text')} AS leaf, {_hash_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
           list_reduce(
               list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
               lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, b)),
               CAST(4294967295 AS BIGINT)
           ) AS crc FROM documents
), leaves AS (
    SELECT doc_id, lang, leaf, CASE WHEN xor(crc, 4294967295) % {merkle.TAMPERED} = 0 THEN lowered ELSE leaf END AS judged,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM told
), nodes AS (
    SELECT lang, 0 AS level, i, n, leaf AS h FROM leaves
    UNION ALL
    SELECT lang, level + 1, i // {merkle.FAN}, (n + {merkle.FAN - 1}) // {merkle.FAN}, sha256(string_agg(h, '' ORDER BY i))
    FROM nodes WHERE n > 1 GROUP BY lang, level, i // {merkle.FAN}, n
), subroots AS (
    SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, i, n, subroot AS h FROM subroots
    UNION ALL
    SELECT level + 1, i // {merkle.FAN}, (n + {merkle.FAN - 1}) // {merkle.FAN}, sha256(string_agg(h, '' ORDER BY i))
    FROM tops WHERE n > 1 GROUP BY level, i // {merkle.FAN}, n
), beside AS (
    SELECT a.lang, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
    FROM nodes AS a JOIN nodes AS b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.i // {merkle.FAN} = b.i // {merkle.FAN} WHERE a.n > 1 GROUP BY ALL
), beside_tops AS (
    SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
    FROM tops AS a JOIN tops AS b ON a.level = b.level AND a.i // {merkle.FAN} = b.i // {merkle.FAN} WHERE a.n > 1 GROUP BY ALL
), steps AS (
    SELECT x.lang, x.i, s.level, s.l, s.r FROM leaves AS x JOIN beside AS s ON x.lang IS NOT DISTINCT FROM s.lang AND s.i = x.i // CAST(pow({merkle.FAN}, s.level) AS BIGINT)
    UNION ALL
    SELECT x.lang, x.i, 100 + s.level, s.l, s.r FROM leaves AS x JOIN subroots AS t ON x.lang IS NOT DISTINCT FROM t.lang
    JOIN beside_tops AS s ON s.i = t.i // CAST(pow({merkle.FAN}, s.level) AS BIGINT)
), paths AS (
    SELECT lang, i, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs, string_agg(l || r, '' ORDER BY level) AS proof FROM steps GROUP BY lang, i
), folded AS (
    SELECT x.doc_id, x.lang, x.i, x.leaf, coalesce(p.ls, []) AS ls, coalesce(p.rs, []) AS rs, coalesce(p.proof, '') AS proof, 1 AS k, x.judged AS h
    FROM leaves AS x LEFT JOIN paths AS p ON x.lang IS NOT DISTINCT FROM p.lang AND x.i = p.i
    UNION ALL
    SELECT doc_id, lang, i, leaf, ls, rs, proof, k + 1, sha256(ls[k] || h || rs[k]) FROM folded WHERE k <= len(ls)
)
SELECT f.doc_id, f.leaf, s.subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM folded AS f JOIN subroots AS s ON f.lang IS NOT DISTINCT FROM s.lang JOIN tops AS t ON t.n = 1 WHERE f.k > len(f.ls)"""


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.overlap_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_hamming_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_join.near_duplicates(table(spark, sf_dir, "documents"))


_OP13_SQL = f"""
WITH RECURSIVE body AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < {hamming_join.WORDS} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {hamming_join.WORDS - 1}], ' ') END AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {hamming_join.WORDS - 2}, 2))) AS i FROM body WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
both_ways AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams AS a JOIN grams AS b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM both_ways AS j JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * j.n >= 85 * (x.n + y.n - j.n)
), reach AS (
    SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.r
), class AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d)
SELECT d AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d = component_id AS kept FROM class LEFT JOIN sizes ON doc_id = d"""


QUERIES = {
    "op1_suffix_dedup": (op1_suffix_dedup, _OP1_SQL),
    "op2_template_extraction": (op2_template_extraction, None),
    "op3_importance_resampling": (op3_importance_resampling, None),
    "op4_bpe_round_trip": (op4_bpe_round_trip, None),
    "op5_quality_rules": (op5_quality_rules, _op5_sql()),
    "op6_chat_format": (op6_chat_format, _OP6_SQL),
    "op7_arc_to_warc": (op7_arc_to_warc, _OP7_SQL),
    "op8_block_knn": (op8_block_knn, _OP8_SQL),
    "op9_ngram_join": (op9_ngram_join, _OP9_SQL),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_merkle_manifest": (op11_merkle_manifest, _OP11_SQL),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_hamming_near_dedup": (op13_hamming_near_dedup, _OP13_SQL),
}
