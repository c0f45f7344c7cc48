"""Line deduplication (DataFrame functions only).

Normalised lines are exploded and hashed, the distinct documents of each hash
are counted, lines over the threshold are dropped by position, and each text is
put together again from the positions that stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import ascii_lower, stored

#: Space and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """``docs`` with columns ``n_lines``, ``n_dropped`` and ``kept_text`` added.

    A line's key is the line without surrounding blanks, A-Z lower-cased. Keys
    of at least ``min_chars`` code points in at least ``min_docs`` distinct
    ``doc_id`` lose all their lines, except in the largest ``doc_id`` that
    holds them (there every occurrence stays).

    Null or empty text: one empty line. Rows with a null ``doc_id`` do not
    count as documents; their lines go when the key is over the threshold.
    Repeated rows of one ``doc_id`` count once and are treated alike. Extra
    columns pass through; of those, ones named like the added columns are
    replaced. An empty table gives an empty table.

    Keys are compared by 128 bits of hash. The three passes move only hashes
    and positions; whole texts are shuffled once, by their own id. A key that a
    third of all documents hold is pre-aggregated for the count, and AQE splits
    its partition in the join (both sides are plain written tables)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("t"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keys = (rows.withColumn("line", line_key(F.col("line"))).where(F.char_length("line") >= min_chars)
            .withColumn("line", ascii_lower(F.col("line")))
            .select("doc_id", "t", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(9), "line").alias("h2")))
    keys = stored(keys, "line_keys")
    over = stored(keys.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
                  .where(F.col("n") >= min_docs).select("h1", "h2", "keeper"), "lines_over")
    gone = (keys.join(over, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "t").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
            .select(F.col("doc_id").alias("_kf_id"), F.col("t").alias("_kf_t"), F.col("gone").alias("_kf_gone")))
    docs = docs.drop("n_lines", "n_dropped", "kept_text")
    both = docs.withColumn("_kf_text", text).join(
        gone.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_kf_id")) & (F.xxhash64("_kf_text") == F.col("_kf_t")), "left")
    lines = F.split("_kf_text", "\n", -1)
    p = F.col("_kf_gone")
    # stay[i] for every position up to the last dropped one: a run of true before each dropped position
    stay = F.flatten(F.transform(p, lambda at, i: F.concat(
        F.array_repeat(F.lit(True), at - F.when(i == 0, F.lit(-1)).otherwise(F.get(p, i - 1)) - 1), F.array(F.lit(False)))))
    kept = F.array_join(F.filter(lines, lambda _, i: F.coalesce(F.get(F.col("_kf_stay"), i), F.lit(True))), "\n")
    return (both.withColumn("_kf_stay", stay)
            .withColumn("n_lines", F.size(lines).cast("long"))
            .withColumn("n_dropped", F.coalesce(F.size("_kf_gone"), F.lit(0)).cast("long"))
            .withColumn("kept_text", F.when(p.isNull(), F.col("_kf_text")).otherwise(kept))
            .drop("_kf_id", "_kf_t", "_kf_gone", "_kf_stay", "_kf_text"))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP9_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
