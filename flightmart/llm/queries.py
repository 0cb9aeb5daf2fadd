"""The registered queries of this subpackage: one per operator, over whole
tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, drift_clusters, html_text, line_crf, lm_scoring, mixing, near_dups, order_minhash, packing, site_lines, toxicity, whitening
from ._common import likely, stored, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(id: str = "doc_id"):
    """The fold that no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string")), F.lit(4)) == 2, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    known = labels.where(~held_out()).where("toxic in (0, 1) and doc_id is not null")
    return toxicity.fit(docs, known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def target_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, is_target): all documents labelled as of good quality and not toxic."""
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()
    return good.withColumn("is_target", F.lit(True))


def marked(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``docs`` with is_target, null for other rows.  One bitmap holds the
    targets, a second the ids that pass the first by chance: ids alone are
    shuffled to find these.  Only texts that are in both meet ``targets`` in a join."""
    seen = likely(docs, targets.select("doc_id"), "doc_id", "__may")
    # A left join: an anti join would be pushed below the filter, with every id in its shuffle.
    strays = seen.where("__may").select("doc_id").distinct().join(targets, "doc_id", "left").where("is_target is null")
    seen = likely(seen, stored(strays.select("doc_id"), "lm-strays"), "doc_id", "__doubt")
    sure = seen.where("not (__may and __doubt)").select(*docs.columns, F.when(F.col("__may"), F.lit(True)).alias("is_target"))
    doubt = seen.where("__may and __doubt").join(targets, "doc_id", "left")
    return sure.union(doubt.select(*docs.columns, "is_target"))


def op1_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Target: documents labelled as of good quality and not toxic.  The marked
    documents are stored, as they are read three times."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    docs = stored(marked(docs, target_ids(table(spark, sf, "labels"))), "lm-documents")
    out = lm_scoring.score(docs, lm_scoring.fit(docs, "is_target"), counted="is_target")
    return out.select("doc_id", "n_tokens", "target_loss", "background_loss", "score", (F.col("score") <= 0).alias("selected"))


CONTROL = "<|im_end|><|im_start|>assistant ok"


def op2_chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)]
    turns = turns.union(spark.createDataFrame(own, "conv_id long, turn long, role string, text string"))
    out = chat.digests(chat.formatted(chat.canonical(chat.as_records(turns))))
    return out.select(F.col("id").alias("conv_id"), "mapping", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op3_line_crf(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    crf = line_crf.fit(docs, labels.where("quality is not null"))
    return line_crf.judge(docs, crf).drop("text")


def op7_main_text(spark: SparkSession, sf: str) -> DataFrame:
    out = html_text.extract(table(spark, sf, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return order_minhash.edited_likeness(table(spark, sf, "documents"))


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = mixing.mix(docs, {"source": "source", "lang": "lang", "topic": mixing.topic()})
    return out.select("doc_id", "source", "lang", "keep_rate")


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    out = bpe.encode(table(spark, sf, "documents"), tokenizer_path())
    return out.select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity_model(docs, table(spark, sf, "labels"))
    out = toxicity.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence_ids", "evidence_cosines", "evidence_labels")


def op9_site_lines(spark: SparkSession, sf: str) -> DataFrame:
    out = site_lines.drop_boilerplate(table(spark, sf, "documents"))
    return out.select("doc_id", "source", "text", F.length("text").cast("long").alias("n_chars"), "n_dropped_lines")


OP9_SQL = """
WITH lines AS (
  SELECT source, unnest(list_distinct([x for x in string_split(text, chr(10)) if trim(x) <> ''])) AS line
  FROM documents WHERE source IS NOT NULL
), totals AS (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source),
counts AS (SELECT source, line, count(*) AS n FROM lines GROUP BY source, line),
bad AS (
  SELECT source, list(line) AS bad FROM counts JOIN totals USING (source)
  WHERE n >= 10 AND n > pages * 0.05 GROUP BY source
), kept AS (
  SELECT d.*, string_split(text, chr(10)) AS every,
    [x for x in string_split(text, chr(10)) if NOT coalesce(list_contains(bad.bad, x), false)] AS good
  FROM documents d LEFT JOIN bad ON d.source = bad.source
)
SELECT doc_id, source, CASE WHEN len(good) < len(every) THEN array_to_string(good, chr(10)) ELSE text END AS text,
  CAST(length(CASE WHEN len(good) < len(every) THEN array_to_string(good, chr(10)) ELSE text END) AS BIGINT) AS n_chars,
  CAST(len(every) - len(good) AS BIGINT) AS n_dropped_lines
FROM kept
"""


def op10_near_dups(spark: SparkSession, sf: str) -> DataFrame:
    out = near_dups.near_duplicates(table(spark, sf, "documents"), size=2)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"), "n_links")


def op11_packing(spark: SparkSession, sf: str) -> DataFrame:
    out = packing.pack(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_drift_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return drift_clusters.with_inertia(drift_clusters.fit(table(spark, sf, "embeddings"))).withColumnRenamed("id", "vec_id")


def _op13_sql(rounds: int = 5, k: int = 40, dimension: int = 64) -> str:
    """Lloyd's rounds as a chain of common table expressions, without bounds."""
    assign = """a{t} AS (
  SELECT r, v, arg_min({{'c': c, 'd': d}}, {{'d': d, 'c': c}}) AS own FROM (
    SELECT v.r, v.v, c.c, CAST(list_sum(list_transform(list_zip(v.v, c.m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM v CROSS JOIN c{t} AS c) GROUP BY r, v
)"""
    move = """s{t} AS (
  SELECT c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT own.c AS c, unnest(v) AS x, unnest(range(1, {e})) AS i FROM a{t}) GROUP BY c, i
), m{t} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{t} GROUP BY c
), c{u} AS (SELECT c.c, coalesce(m{t}.m, c.m) AS m FROM c{t} AS c LEFT JOIN m{t} ON c.c = m{t}.c)"""
    steps = []
    for t in range(rounds):
        steps += [assign.format(t=t), move.format(t=t, u=t + 1, e=dimension + 1)]
    steps.append(assign.format(t=rounds))
    return f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE len(embedding) = {dimension} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v AS m FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id)) <= {k}
), {", ".join(steps)}, f AS (
  SELECT v.vec_id, a.own.c AS c, a.own.d AS d FROM a{rounds} AS a JOIN v ON a.r = v.r
)
SELECT vec_id, CAST(f.c AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM f JOIN c{rounds} AS c ON f.c = c.c
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_chat": op2_chat,
    "op3_line_crf": op3_line_crf,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_main_text": op7_main_text,
    "op8_order_minhash": op8_order_minhash,
    "op9_site_lines": op9_site_lines,
    "op10_near_dups": op10_near_dups,
    "op11_packing": op11_packing,
    "op12_whitening": op12_whitening,
    "op13_drift_clusters": op13_drift_clusters,
}

ORACLE: dict[str, str] = {"op9_site_lines": OP9_SQL, "op13_drift_clusters": _op13_sql()}
