"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import align, bpe, chat, decontaminate, licences, near_dup, nearest, quality, secrets, shards, suffix_dedup, toxicity, variants
from .shared import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return wrap


@query()
def op2_bpe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.col("n_tokens").cast("long"), "ids_sha256", "decoded_sha256")


@query(licences.oracle())
def op1_licences(spark, sf):
    out = licences.scanned(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
        F.size("sentence_ids").cast("long").alias("n_sentences"),
    )


@query()
def op6_shards(spark, sf):
    out = shards.sharded(table(spark, sf, "documents").select("doc_id", "text"), 24)
    law, none = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", law, "shard", F.col("slot").cast("long"), none)


_PROBE = r"\### Assistant: </turn> ok"
_TURNS = f"""WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_PROBE}'), (-7, 1, 'assistant', '{_PROBE}')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)"""


@query(
    rf"""{_TURNS} SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('### : ') + length(role) + length(text) + length(' </turn>') + 1
      + length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '</turn>', ''))) // 7
      + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x) - 2)), 0)) AS BIGINT) AS formatted_chars,
    regexp_full_match(string_agg(substr(role, 1, 1), '' ORDER BY turn, role, text), 's?(ua)*u?')
      AND string_agg(role, '' ORDER BY turn, role, text) <> 'system' AS valid
    FROM t GROUP BY conv_id"""
)
def op9_chat(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        "SELECT -7L AS conv_id, t.turn, t.role, :text AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)",
        args={"text": _PROBE},
    )
    out = chat.read_back(chat.formatted(rows.unionByName(probe)))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = chat.learned_text(F.col("segments"))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def _held(fold: int, folds: int):
    return (F.crc32(F.col("doc_id").cast("string")) % folds == fold).alias("held_out")


@query()
def op4_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.learned(docs, table(spark, sf, "labels"))
    out = toxicity.scored(docs, model)
    return out.select("doc_id", _held(1, 3), "score", "predicted", F.size("spans").alias("n_spans"))


@query()
def op3_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.learned(docs, table(spark, sf, "labels"))
    return quality.scored(docs, model).select("doc_id", _held(2, 4), "score", "predicted")


@query(
    """WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: x >= 0) AS bits FROM embeddings),
    d AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.bits, r.bits),
        lambda p: CASE WHEN p[1] <> p[2] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
      FROM b q JOIN b r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, distance
    FROM d QUALIFY rank <= 10"""
)
def op8_nearest(spark, sf):
    vectors = table(spark, sf, "embeddings")
    rows = vectors.select(F.col("vec_id").alias("id"), nearest.sign_code(F.col("embedding")).alias("code"))
    out = nearest.nearest(rows, rows.filter(F.col("id") % 100 == 0), 10, segments=8)
    return out.withColumnRenamed("id", "vec_id")


@query()
def op5_decontaminate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = decontaminate.marked(docs, table(spark, sf, "benchmark"))
    words = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "contaminated", "items", words.cast("long").alias("n_words"))


@query(
    """WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
    w AS (SELECT doc_id, CAST(s.i AS BIGINT) AS s, substr(x, CAST(2 * s.i + 1 AS BIGINT), 200) AS k FROM h, unnest(range(greatest(n - 99, 0))) s(i)),
    a AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM w),
    m AS (SELECT *, max(s + 100) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM a WHERE r > 1),
    g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM m),
    r AS (SELECT doc_id, span, min(s) AS a, max(s) + 100 AS z FROM g GROUP BY doc_id, span),
    k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
    p AS (SELECT h.doc_id, string_agg(substr(x, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS pieces,
        max(z) AS done, count(*) AS n_spans, sum(z - a) AS n_removed FROM h JOIN k ON h.doc_id = k.doc_id GROUP BY h.doc_id)
    SELECT h.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
      CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
      sha256(unhex(coalesce(pieces || substr(x, CAST(2 * done + 1 AS BIGINT)), x))) AS kept_sha256
    FROM h LEFT JOIN p ON h.doc_id = p.doc_id"""
)
def op10_suffix_dedup(spark, sf):
    out = suffix_dedup.repeats_removed(table(spark, sf, "documents").select("doc_id", "text"), keep_text=False)
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS g
      FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) u(i) WHERE len(ws) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
    r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id)
    SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.root) AS component_id, min(r.root) = d.doc_id AS kept
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id, n.n"""
)
def op7_near_dup(spark, sf):
    out = near_dup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op11_align(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    paths = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.aligned(docs, *paths, keep_text=False)


@query(secrets.oracle())
def op12_secrets(spark, sf):
    out = secrets.scanned(table(spark, sf, "documents").select("doc_id", "text"), keep_text=False)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(secrets.BASE))
    return out.select(
        "doc_id", *[count(k) for k in secrets.BASE], F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans")
    )


@query(
    """WITH RECURSIVE t AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS source,
      unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    o AS (SELECT source, run, count(*) AS times, hex(encode(source || ':' || run)) AS x FROM t WHERE length(run) >= 5 GROUP BY source, run),
    h AS (SELECT run, times, xor(list_reduce([4294967295] || list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, CAST(i AS BIGINT), 2) AS BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) AS h FROM o),
    s AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h),
    w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
    d AS (SELECT word, i, substr(word, 1, CAST(i - 1 AS BIGINT)) || substr(word, CAST(i + 1 AS BIGINT)) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
    p AS (SELECT a.word, b.word AS near FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT d.word, d.rest FROM d SEMI JOIN w ON d.rest = w.word UNION SELECT d.rest, d.word FROM d SEMI JOIN w ON d.rest = w.word),
    b AS (SELECT p.word, count(*) OVER (PARTITION BY p.word) AS n_near, p.near, v.n AS near_n FROM p JOIN w v ON p.near = v.word
      QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, p.near) = 1),
    f AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
      FROM w LEFT JOIN b ON w.word = b.word),
    r AS (SELECT word, word AS place FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON r.place = f.word WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, r.place AS root, f.n, f.n_near, f.form_n FROM f JOIN r ON f.word = r.word JOIN f e ON e.word = r.place AND e.form IS NULL"""
)
def op13_variants(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return variants.grouped(variants.word_counts(docs, noise="doc_id"))
