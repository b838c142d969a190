"""The registered queries of the training-data operators, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolex.llm import (
    codes,
    decontaminate,
    edit_counts,
    exact_dedup,
    language,
    licenses,
    mixing,
    reply_trees,
    simhash,
    sketches,
    token_files,
    toxicity,
    whitening,
)
from chronolex.sources.scratch import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: contaminated, item_ids, item_id, share."""
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: text_digest, license_id, notices."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op5_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, with three edits derived from its text: token counts before and after them.

    A word is written over at a quarter of the text, words are put in at its half, and twenty
    characters are taken out at three quarters.
    """
    docs = _table(spark, sf_dir, "documents")
    n = F.length(F.coalesce("text", F.lit("")))
    part = lambda quarter: F.floor(n * quarter / 4).cast("int")
    edits = F.array(
        F.struct(part(1).alias("pos"), F.lit(6).alias("removed"), F.concat(F.lit("edited-"), "doc_id").alias("added")),
        F.struct(part(2).alias("pos"), F.lit(0).alias("removed"), F.lit(" and new words,").alias("added")),
        F.struct(part(3).alias("pos"), F.lit(20).alias("removed"), F.lit("").alias("added")),
    )
    return edit_counts.edited_counts(docs.withColumn("edits", edits))


@_query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    manifest = token_files.write(_table(spark, sf_dir, "documents"), folder)
    return token_files.read(manifest, folder)


@_query
def op7_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "struct<conv_id:bigint,turn:bigint,role:string,text:string>"
    hard = r"\### Assistant: </turn> ok"
    added = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(-7).alias("conv_id"), F.lit(turn).alias("turn"), F.lit(role).alias("role"), F.lit(hard).alias("text")
                    ).cast(own)
                    for turn, role in enumerate(("user", "assistant"))
                ]
            )
        )
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    formatted = reply_trees.conversations(reply_trees.reply_tree(turns))
    parsed = formatted.select(
        F.col("tree").alias("conv_id"),
        "formatted",
        reply_trees.parse(F.col("formatted")).alias("turns"),
        reply_trees.trained_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@_query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


@_query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


@_query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(_table(spark, sf_dir, "embeddings"))


@_query
def op12_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_edits(_table(spark, sf_dir, "documents"))


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


WHITE_SPACE = r"[\x20\x09-\x0D]"

ORACLES["op2_exact_dedup"] = lambda: f"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '{WHITE_SPACE}', '', 'g') AS bare FROM documents),
best AS (SELECT bare, count(*) AS group_size, arg_min(doc_id, (-points, doc_id)) AS keep_id FROM n GROUP BY bare)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.bare) AS text_sha256
FROM n JOIN best ON n.bare = best.bare
"""

_MARKED = r"replace(replace(replace(coalesce({0}, ''), '\', '\b'), '</turn>', '\t'), '###', '\h')"
ORACLES["op7_reply_trees"] = lambda: rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(4 + length(replace(replace({_MARKED.format('role')}, ':', '\c'), chr(10), '\n')) + 2 + length({_MARKED.format('text')}) + 8) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def _canonical(column: str) -> str:
    made = f"regexp_replace(lower(coalesce({column}, '')), '{licenses.COPYRIGHT_LINE}', '', 'g')"
    made = rf"' ' || regexp_replace({made}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
    for other, usual in licenses.SPELLINGS:
        made = f"replace({made}, ' {other} ', ' {usual} ')"
    return f"trim({made}, ' ')"


def _license_sql() -> str:
    known = ", ".join("('{}', '{}')".format(i, text.replace("'", "''")) for i, text in licenses.KNOWN)
    return f"""
WITH known AS (SELECT sha256({_canonical('text')}) AS digest, min(id) AS license_id FROM (VALUES {known}) AS k(id, text) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM lines JOIN known ON sha256({_canonical('line')}) = digest GROUP BY doc_id),
whole AS (SELECT doc_id, sha256({_canonical('text')}) AS text_digest FROM documents)
SELECT doc_id, text_digest, license_id, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known ON digest = text_digest LEFT JOIN found USING (doc_id)
"""


ORACLES["op3_license_scan"] = _license_sql


_SQUARED = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
_FLOORED = "(sum(x[pos]) - ((sum(x[pos]) % count(*)) + count(*)) % count(*)) // count(*)"


def _codes_sql() -> str:
    rounds = []
    for k in range(7):
        rounds.append(f"""a{k} AS (SELECT vec_id, label, part, any_value(x) AS x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM
  (SELECT vec_id, label, part, x, entry, {_SQUARED} AS d FROM p JOIN b{k} USING (part)) GROUP BY vec_id, label, part)""")
        if k < 6:
            rounds.append(f"""m{k} AS (SELECT part, entry, pos, CAST({_FLOORED} AS BIGINT) AS v
  FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS pos FROM a{k}) GROUP BY part, entry, pos),
b{k + 1} AS (SELECT part, entry, coalesce(n, c) AS c FROM b{k} LEFT JOIN
  (SELECT part, entry, list(v ORDER BY pos) AS n FROM m{k} GROUP BY part, entry) USING (part, entry))""")
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda e: CAST(floor(4096 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
p AS (SELECT vec_id, label, part, x[part * (len(x) // 8) + 1 : (part + 1) * (len(x) // 8)] AS x FROM v, (SELECT unnest(range(8)) AS part)),
b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p QUALIFY entry < 16),
{", ".join(rounds)},
r AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY vec_id, label),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r, s
"""


ORACLES["op11_vector_codes"] = _codes_sql

# One of 16 hashes: those below 2^60, of five words each.
ORACLES["op12_sketches"] = lambda: r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
f AS (SELECT *, coalesce(lead(text) OVER o, first_value(text) OVER o) AS following,
  coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id FROM d WINDOW o AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, n, next_id, text, substr(text, 1, n - n // 2) || substr(following, 1, n // 2) AS edited FROM f),
t AS (SELECT doc_id, true AS own, text FROM e UNION ALL SELECT doc_id, false, edited FROM e),
w AS (SELECT doc_id, own, regexp_extract_all(lower(text), '[^ 	-
]+') AS w FROM t),
h AS (SELECT doc_id, own, CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, greatest(len(w) - 4, 1) + 1),
  lambda i: substr(md5(array_to_string(list_slice(w, i, i + 4), ' ')), 1, 16)) END AS h FROM w),
k AS (SELECT doc_id, own, list_sort(list_distinct(CASE WHEN len(list_filter(h, lambda x: x < '1000000000000000')) > 0
  THEN list_filter(h, lambda x: x < '1000000000000000') WHEN len(h) > 0 THEN [list_min(h)] ELSE [] END)) AS s FROM h),
j AS (SELECT e.doc_id, n, sha256(edited) AS edited_sha256, a.s AS a, b.s AS b, c.s AS c, len(list_intersect(a.s, b.s)) AS ab, len(list_intersect(a.s, c.s)) AS ac
  FROM e JOIN k a ON a.doc_id = e.doc_id AND a.own JOIN k b ON b.doc_id = e.doc_id AND NOT b.own JOIN k c ON c.doc_id = e.next_id AND c.own)
SELECT doc_id, n AS n_chars, edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
  CASE WHEN len(a) + len(b) = 0 THEN 1.0::DOUBLE ELSE ab::DOUBLE / (len(a) + len(b) - ab) END AS near_edited,
  CASE WHEN len(a) + len(c) = 0 THEN 1.0::DOUBLE ELSE ac::DOUBLE / (len(a) + len(c) - ac) END AS near_next,
  CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE ab::DOUBLE / len(a) END AS within_edited,
  CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE ac::DOUBLE / len(a) END AS within_next FROM j
"""
