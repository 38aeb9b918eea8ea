"""The registered queries of this subpackage and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickward.llm.best_fit import cut_documents, pack
from tickward.llm.collocations import collocations
from tickward.llm.common import fold, ship
from tickward.llm.cuckoo_index import exact_duplicates
from tickward.llm.dart_minhash import near_duplicates
from tickward.llm.interpolation import HELD_OUT, TRAINING, TUNING, score_documents
from tickward.llm.mixing import sized, take
from tickward.llm.nra_topk import exact_top
from tickward.llm.perm_index import nearest
from tickward.llm.pu_quality import quality_model
from tickward.llm.reply_trees import chosen_paths, format_paths, linear_replies, masked, parse
from tickward.llm.template import extract
from tickward.llm.toxicity import toxicity_model
from tickward.llm.whitening import whitened


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), counted=True)


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op4_no_random_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return exact_top(vectors, vectors.where("vec_id % 100 = 0"), k=10)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS d, unnest(embedding) AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), bad AS (
  SELECT vec_id FROM v WHERE c IS NULL OR NOT isfinite(c)
), i AS (
  SELECT vec_id, d, CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT) AS c FROM v WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(sum(q.c * x.c) AS BIGINT) AS score
  FROM i q JOIN i x ON q.d = x.d AND q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, x.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def op3_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(cut_documents(_table(spark, sf_dir, "documents")))


def op5_template_deduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op6_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = take(sized(_table(spark, sf_dir, "documents")))
    words = (F.col("first_pass") + F.col("second_pass")).alias("taken")
    return taken.select("doc_id", "size", "source_size", "target", words)


# Both texts of the conversation that tests the escapes.
HARD_TEXT = "\\### Assistant: </turn> ok"


def op7_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = [(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)]
    turns = turns.unionAll(spark.createDataFrame(hard, turns.schema))
    formatted = format_paths(chosen_paths(linear_replies(turns), acyclic=True))
    read = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), masked(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP6_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * CAST(2 AS DOUBLE) AS lim FROM s
), l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(sum(lim) OVER b, 0))
            / (CAST(sum(weight) OVER () AS DOUBLE) - coalesce(sum(weight) OVER b, 0)) AS lev
  FROM w WINDOW b AS (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), o AS (
  SELECT arg_min(lev, (lim / weight, place)) AS lev FROM l WHERE lim > lev * weight
), t AS (
  SELECT source, place, source_size, CASE WHEN lim <= l.lev * weight THEN lim ELSE o.lev * weight END AS target FROM l LEFT JOIN o ON true
), c AS (
  SELECT *, coalesce(sum(target) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         sum(target) OVER () AS total FROM t
), k AS (
  SELECT greatest(1, CAST(ceil(max(total) / 1048576) AS BIGINT)) AS block, max(total) AS total FROM c
), points AS (
  SELECT CAST(i AS DOUBLE) * CAST('0.6180339887498949' AS DOUBLE) AS p FROM k, unnest(range(CAST(ceil(total / block) AS BIGINT))) AS u(i)
), slots AS (
  SELECT c.place, count(*) AS n FROM c JOIN points ON p - floor(p) >= c.start / c.total AND p - floor(p) < (c.start + c.target) / c.total
  WHERE c.target > 0 GROUP BY c.place
), laid AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS pos FROM d
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, coalesce(n, 0) * block - pos)) + greatest(0, least(size, coalesce(n, 0) * block - pos - source_size)) AS BIGINT) AS taken
FROM laid JOIN c ON laid.source IS NOT DISTINCT FROM c.source LEFT JOIN slots USING (place), k
"""

OP7_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), spoken AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<turn ' || replace(replace(replace(replace(role, '\\', '\\s'), '<', '\\l'), '>', '\\g'), chr(10), '\\n') || '>.'
                    || replace(replace(text, '\\', '\\s'), '<', '\\l') || '</turn>.')) AS chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM spoken
"""


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = quality_model(documents, _table(spark, sf_dir, "labels"))
    scored = documents.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_pattern_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = toxicity_model(documents, _table(spark, sf_dir, "labels"))
    scored = documents.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold(F.col("doc_id"), 10)
    role = F.when(part == 0, HELD_OUT).when(part == 1, TUNING).otherwise(TRAINING)
    scored = score_documents(_table(spark, sf_dir, "documents"), role)
    return scored.withColumn("held_out", F.col("role") == HELD_OUT).drop("role")


def op11_cuckoo_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""


def op12_suffix_quicksort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p
), s AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), g AS (
  SELECT lang, unnest([ws[i:i], CASE WHEN i + 1 <= len(ws) THEN ws[i:i+1] END, CASE WHEN i + 2 <= len(ws) THEN ws[i:i+2] END,
                       CASE WHEN i + 3 <= len(ws) THEN ws[i:i+3] END]) AS ph FROM s
), f AS (
  SELECT lang, ph, array_to_string(ph, ' ') AS phrase, count(*) AS n FROM g WHERE ph IS NOT NULL GROUP BY lang, ph HAVING count(*) >= 30
), total AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
), cuts AS (
  SELECT lang, ph, phrase, n AS a, unnest(range(1, len(ph))) AS k FROM f WHERE len(ph) > 1
), scored AS (
  SELECT c.lang, c.ph, c.phrase, c.a, c.k, x.n AS l, y.n AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.n + y.n) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.ph = c.ph[1:c.k] JOIN f y ON y.lang = c.lang AND y.ph = c.ph[c.k + 1:]
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1
), inner_spans AS (
  SELECT lang, n, unnest(CASE len(ph) WHEN 3 THEN [ph[1:2], ph[2:3]] ELSE [ph[1:2], ph[2:3], ph[3:4], ph[1:3], ph[2:4]] END) AS ph
  FROM f WHERE len(ph) > 2
), absorbed AS (
  SELECT lang, ph, max(n) AS n FROM inner_spans GROUP BY lang, ph
), kept AS (
  SELECT s.* FROM weakest s LEFT JOIN absorbed b ON b.lang = s.lang AND b.ph = s.ph
  WHERE b.n IS NULL OR CAST(100 AS HUGEINT) * b.n < CAST(80 AS HUGEINT) * s.a
)
SELECT lang, rank, phrase, a, l, r, total.n AS n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000
"""


def op13_shifted_cholesky_qr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_permutation_index": op2_permutation_index,
    "op3_best_fit": op3_best_fit,
    "op4_no_random_access": op4_no_random_access,
    "op5_template_deduction": op5_template_deduction,
    "op6_source_schedule": op6_source_schedule,
    "op7_reply_trees": op7_reply_trees,
    "op8_pu_quality": op8_pu_quality,
    "op9_pattern_grammar": op9_pattern_grammar,
    "op10_deleted_interpolation": op10_deleted_interpolation,
    "op11_cuckoo_index": op11_cuckoo_index,
    "op12_suffix_quicksort": op12_suffix_quicksort,
    "op13_shifted_cholesky_qr": op13_shifted_cholesky_qr,
}

ORACLES: dict[str, str] = {
    "op4_no_random_access": OP4_SQL,
    "op6_source_schedule": OP6_SQL,
    "op7_reply_trees": OP7_SQL,
    "op11_cuckoo_index": OP11_SQL,
    "op12_suffix_quicksort": OP12_SQL,
}
