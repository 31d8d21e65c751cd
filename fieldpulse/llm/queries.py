"""The operators as queries over the given tables, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm import (
    chat, conversation_repair, decontaminate, language_id, line_dedup, mixing, neighbours, ngram_join, pii, quality, secret_scan, toxicity, whitening,
)
from fieldpulse.llm.learning import fold
from fieldpulse.llm.tables import given, stored

Query = Callable[[SparkSession, str], DataFrame]


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(given(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels")
    fitted = toxicity.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return toxicity.score(docs, fitted).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(given(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "chance")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels")
    fitted = quality.fit(docs, labels, fold(F.col("doc_id"), 3) != 1)
    return quality.score(docs, fitted).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    # In two insertions, so that the second one asks the filters which of its keys are new.
    late = F.pmod(F.xxhash64("doc_id"), F.lit(8)) == 0
    index = line_dedup.LineIndex(spark).insert(docs.where(~late)).insert(docs.where(late))
    return line_dedup.without_common_lines(docs, index).select(
        "doc_id", "n_lines", F.col("n_dropped").cast("long").alias("n_dropped"), _sha256(F.col("kept")).alias("kept_sha256"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    made = chat.examples(given(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))
    loss = chat.unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    turns = F.array_join(F.transform(chat.read_back(F.col("whole")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    per = made.groupBy("conv_id").agg(
        F.max("n_turns").cast("long").alias("n_turns"), F.max_by("text", "n_turns").alias("whole"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", loss.alias("loss")))), lambda e: e["loss"]), "").alias("loss"),
        F.sum(F.length("text")).alias("formatted_chars"))
    return per.select("conv_id", "n_turns", _sha256(turns).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                      _sha256(F.col("loss")).alias("loss_sha256"), "formatted_chars")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(given(spark, sf_dir, "documents"))
    kinds = [rule.kind for rule in secret_scan.BASE_RULES]
    base = _of_kind(F.col("spans"), *kinds)
    return found.select("doc_id", *(F.size(_of_kind(F.col("spans"), kind)).cast("long").alias(f"n_{kind}") for kind in kinds),
                        _sha256(_span_text(base)).alias("base_sha256"), _span_text(F.col("spans")).alias("spans"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last_word"] - s["first_word"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        _sha256(F.array_join("items", ",")).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(given(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(given(spark, sf_dir, "documents"))
    base = _of_kind(F.col("spans"), *pii.KINDS)
    return found.select("doc_id", *(F.size(_of_kind(F.col("spans"), kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS),
                        _sha256(_span_text(base)).alias("base_sha256"), _span_text(F.col("spans")).alias("spans"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = given(spark, sf_dir, "documents"), fold(F.col("doc_id"), 4) == 2
    found = language_id.identify(docs, language_id.learn(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(given(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "conversations")
    report, repaired = conversation_repair.repair(conversation_repair.damage(rows))
    known = stored(report.join(conversation_repair.line_digests(repaired).withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")), "left")
                   .drop("_id").withColumn("repaired_sha256", F.coalesce("repaired_sha256", _sha256(F.lit("")))), "repaired")
    gone = rows.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    zero = F.lit(0).cast("long")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return gone.join(known, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        F.col("_id").alias("conv_id"), *(F.coalesce(name, zero).alias(name) for name in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", _sha256(F.lit(""))).alias("repaired_sha256"))


QUERIES: tuple[Query, ...] = (op1_ngram_join, op2_toxicity, op3_mixing, op4_quality, op5_line_dedup, op6_chat, op7_secret_scan,
                              op8_decontamination, op9_neighbours, op10_pii, op11_language_id, op12_whitening, op13_conversation_repair)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


ORACLES = {
    # Targets by the level at which the sources' shares, bounded by three times their size, add up to the whole; chances by the largest size that is
    # not certain; at the cut the nearer side, and then one exchange.
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u,
         row_number() OVER () AS n
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(3 * source_size) OVER (
             ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per_source),
targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * (
           SELECT arg_min(level, source_size / weight) FROM levels WHERE level * weight <= 3 * source_size)) AS target
  FROM levels),
rates AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS whole FROM targets),
rests AS (
  SELECT *, target - whole * source_size AS rest FROM rates),
sizes AS (
  SELECT source, size, count(*) AS n FROM sized WHERE size > 0 GROUP BY source, size),
chances AS (
  SELECT z.source, z.size,
         (rest - (sum(n * z.size) OVER (PARTITION BY z.source ORDER BY z.size DESC) - n * z.size))
           / CAST(sum(n * z.size * z.size) OVER (PARTITION BY z.source ORDER BY z.size) AS DOUBLE) AS c
  FROM sizes z JOIN rests r ON z.source IS NOT DISTINCT FROM r.source),
certain AS (
  SELECT source, max(size) AS most, arg_max(c, size) AS c FROM chances WHERE c * size < 1 GROUP BY source),
ranked AS (
  SELECT s.*, r.source_size, r.target, r.whole, r.rest,
         CASE WHEN r.rest > 0 THEN CASE WHEN s.size > k.most THEN 1.0 ELSE coalesce(k.c * s.size, 0.0) END ELSE 0.0 END::DOUBLE AS chance
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source LEFT JOIN certain k ON s.source IS NOT DISTINCT FROM k.source),
ordered AS (
  SELECT *, CASE WHEN chance >= 1 THEN 0.0 WHEN chance > 0 THEN (u / (1 - u)) / (chance / (1 - chance)) END AS odds FROM ranked),
summed AS (
  SELECT *, CASE WHEN odds IS NOT NULL THEN sum(size) FILTER (WHERE odds IS NOT NULL) OVER (
    PARTITION BY source ORDER BY odds NULLS LAST, id NULLS FIRST, size, n ROWS UNBOUNDED PRECEDING) END AS upto FROM ordered),
taken AS (
  SELECT *, coalesce(upto <= rest OR (upto - size <= rest AND upto - rest < rest - upto + size), FALSE) AS extra FROM summed),
gaps AS (
  SELECT *, rest - coalesce(sum(size) FILTER (WHERE extra) OVER (PARTITION BY source), 0) AS gap FROM taken),
swaps AS (
  SELECT *, row_number() OVER (PARTITION BY source, helps ORDER BY off, extra, coalesce(odds, 'inf'::DOUBLE), id IS NOT NULL, id, size, n) = 1 AND helps AS swapped
  FROM (SELECT *, abs(gap - CASE WHEN extra THEN -size ELSE size END) AS off,
               size > 0 AND rest > 0 AND abs(gap - CASE WHEN extra THEN -size ELSE size END) < abs(gap) AS helps FROM gaps))
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN extra <> swapped THEN 1 ELSE 0 END) AS BIGINT) AS taken, chance
FROM swaps""",
    "op5_line_dedup": r"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM cut),
common AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.holder AS dropped FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op6_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length('<|turn|><|text|><|end|>') + length(role) + length(text)
            + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n FROM turns),
summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE role = 'assistant' OR pos = n) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id""",
    "op8_decontamination": r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:least(i + 9, len(w))], ' ') AS phrase, least(10, len(w)) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size)),
hits AS (SELECT p.doc_id, p.i, p.size, v.item_id FROM places p JOIN windows v USING (phrase, size)),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op9_neighbours": r"""
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda a, b: a + b) AS score
  FROM usable q, usable c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
    # Cheapest paths row by row, one per state; no search. The remainder is CRC32 spelled out bit by bit.
    "op13_conversation_repair": r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS chars FROM conversations),
harmed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
           list_concat([4294967295::UBIGINT], flatten(list_transform(chars, lambda c: [ord(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, x: CASE WHEN (xor(c, x) & 1::UBIGINT) = 1 THEN xor(xor(c, x) >> 1, 3988292384::UBIGINT) ELSE xor(c, x) >> 1 END), 4294967295::UBIGINT) % 20 AS harm
  FROM named),
rows_after AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE harm WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM rows_after),
judged AS (
  SELECT conv_id, turn, pos, role, text, substr(role, 1, 1) AS initial,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '-' END AS fault
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM judged GROUP BY conv_id),
-- A way is its cost, its edits and the rows it leaves; z nothing yet, s after a system row, u a user's, a an assistant's.
ways AS (
  SELECT conv_id, 0::BIGINT AS pos, n, {'cost': 0::BIGINT, 'edits': '', 'left': []::VARCHAR[]} AS z, NULL::STRUCT(cost BIGINT, edits VARCHAR, "left" VARCHAR[]) AS s,
         NULL::STRUCT(cost BIGINT, edits VARCHAR, "left" VARCHAR[]) AS u, NULL::STRUCT(cost BIGINT, edits VARCHAR, "left" VARCHAR[]) AS a
  FROM counted
  UNION ALL
  SELECT conv_id, pos, n,
         {'cost': z.cost + 2, 'edits': z.edits || 'D', 'left': z.left},
         list_sort(list_filter([CASE WHEN s IS NOT NULL THEN {'cost': s.cost + 2, 'edits': s.edits || 'D', 'left': s.left} END,
                                CASE WHEN stays AND initial = 's' THEN {'cost': z.cost + more, 'edits': z.edits || 'K', 'left': list_append(z.left, role || ':' || text)} END], lambda w: w IS NOT NULL))[1],
         list_sort(list_filter([{'cost': u2.cost + 2, 'edits': u2.edits || 'D', 'left': u2.left},
                                CASE WHEN stays AND initial = 'u' THEN {'cost': pre.cost + more, 'edits': pre.edits || 'K', 'left': list_append(pre.left, role || ':' || text)} END,
                                CASE WHEN stays THEN {'cost': pre.cost + more + 1, 'edits': pre.edits || 'R', 'left': list_append(pre.left, 'user:' || text)} END], lambda w: w IS NOT NULL))[1],
         list_sort(list_filter([{'cost': a2.cost + 2, 'edits': a2.edits || 'D', 'left': a2.left},
                                CASE WHEN stays AND initial = 'a' THEN {'cost': u2.cost + more, 'edits': u2.edits || 'K', 'left': list_append(u2.left, role || ':' || text)} END,
                                CASE WHEN stays THEN {'cost': u2.cost + more + 1, 'edits': u2.edits || 'R', 'left': list_append(u2.left, 'assistant:' || text)} END], lambda w: w IS NOT NULL))[1]
  FROM (SELECT *, list_sort(list_filter([z, s, a2], lambda w: w IS NOT NULL))[1] AS pre
        FROM (SELECT *, list_sort(list_filter([a, {'cost': u2.cost + 5, 'edits': u2.edits || 'I', 'left': list_append(u2.left, 'assistant:')}], lambda w: w IS NOT NULL))[1] AS a2
              FROM (SELECT w.conv_id, w.pos + 1 AS pos, w.n, w.z, w.s, w.a, j.initial, j.role, j.text, j.fault IN ('t', '-') AS stays,
                           CASE j.fault WHEN 't' THEN 5 ELSE 0 END AS more,
                           list_sort(list_filter([w.u, {'cost': w.z.cost + 5, 'edits': w.z.edits || 'I', 'left': list_append(w.z.left, 'user:')},
                                                  CASE WHEN w.s IS NOT NULL THEN {'cost': w.s.cost + 5, 'edits': w.s.edits || 'I', 'left': list_append(w.s.left, 'user:')} END,
                                                  CASE WHEN w.a IS NOT NULL THEN {'cost': w.a.cost + 5, 'edits': w.a.edits || 'I', 'left': list_append(w.a.left, 'user:')} END],
                                                 lambda w: w IS NOT NULL))[1] AS u2
                    FROM ways w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.pos = w.pos + 1)))),
ended AS (
  SELECT conv_id, list_sort(list_filter([z, a, CASE WHEN u IS NOT NULL THEN {'cost': u.cost + 5, 'edits': u.edits || 'I', 'left': list_append(u.left, 'assistant:')} END,
           CASE WHEN s IS NOT NULL THEN {'cost': s.cost + 10, 'edits': s.edits || 'II', 'left': list_concat(s.left, ['user:', 'assistant:'])} END], lambda w: w IS NOT NULL))[1] AS best
  FROM ways WHERE pos = n)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost, coalesce(e.best.edits, '') AS audit,
       sha256(coalesce(array_to_string(e.best.left, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id""",
}
