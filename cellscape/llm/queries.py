"""The registered queries opN_<name> over the given tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.llm import (
    bpe, conversation_repair, decontam, exact_dedup, langid, license_scan, ngram_join, quality, quality_rules, shard, spelling,
    suffix_dedup, url_filter,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fixed values of the contract.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: License statements to look for (fixed texts of public licenses).
LICENSES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("all-rights-reserved", "All rights reserved."),
]
N_SHARDS = 16
MIN_SCORE = 0.3


def _literal(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _literal(spark, URL_RULES, ["host", "path", "verdict"])
    return (url_filter.url_verdicts(table(spark, sf_dir, "pages"), rules)
            .select("page_id", "host", "path", "rule", "verdict"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokens = bpe.read_ranks(tokenizer_file())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, tokens, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_groups(table(spark, sf_dir, "documents"), k=3, similarity=90)


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (shard.kd_shards(docs, N_SHARDS, dims=["lang", "source"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def op6_license_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five one-line statements alone, which SQL can express."""
    templates = _literal(spark, LICENSES, ["template_id", "text"])
    return (license_scan.license_scan(table(spark, sf_dir, "documents"), templates)
            .select("doc_id", F.concat_ws(",", "licenses").alias("licenses"), "containment", "n_windows"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole license texts, headers and the one-line statements; near variants are told apart."""
    templates = _literal(spark, [*LICENSES, *license_scan.shipped_templates()], ["template_id", "text"])
    return (license_scan.license_scan(table(spark, sf_dir, "documents"), templates, explained=True)
            .select("doc_id", F.concat_ws(",", "licenses").alias("licenses"), "containment", "n_windows"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), 400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), (F.size("spans") > 0).alias("cut"))


def _fold(of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(_fold(4) != 2))
    found = langid.detect(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    return quality.train(docs, labels.where(_fold(5) != 0))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= MIN_SCORE).cast("int").alias("predicted"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def damaged_words(docs: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n): the runs of letters with the contract's damage, that are long and frequent enough.  A null id counts as empty."""
    named = docs.select("text", F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("doc_id"))
    # Damage only shortens a run, so those that are too short already need no look at it.
    found = spelling.runs(named, min_length=min_length).withColumn("h", F.crc32(F.concat("doc_id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return (found.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(damaged_words(table(spark, sf_dir, "documents")))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """The rows of the table with the contract's damage; a dropped row stays with ``present`` false."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, hit = F.coalesce("text", space), F.col("hit")
    return (conversations.withColumn("hit", F.crc32(key.cast("binary")) % 20)
            .select("conv_id", "turn", F.when(hit == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
                    F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                    (hit != 0).alias("present"),
                    F.explode(F.array_repeat(F.lit(0), F.when(hit == 3, 2).otherwise(1))).alias("copy")).drop("copy"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged_conversations(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows, present=F.col("present"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_bpe": op3_bpe,
    "op4_ngram_join": op4_ngram_join,
    "op5_kd_shards": op5_kd_shards,
    "op6_license_scan": op6_license_scan,
    "op6_license_statements": op6_license_statements,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_quality_rules": op12_quality_rules,
    "op13_conversation_repair": op13_conversation_repair,
}

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), " + _UPPER + r"), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)


ORACLE = {
    "op1_url_filter": rf"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_UPPER}) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(rhost, rpath, verdict) AS (VALUES {_values(URL_RULES)})
SELECT page_id, host, path,
       (SELECT max_by(rhost || rpath, length(rhost || rpath)) FROM r
        WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
       coalesce((SELECT max_by(verdict, length(rhost || rpath)) FROM r
                 WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)), 'allow') AS verdict
FROM p""",
    "op2_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)""",
    "op4_ngram_join": rf"""
WITH RECURSIVE dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
        THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM dw),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
      WHERE 100 * c >= 90 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT node, b FROM r JOIN l ON seen = a)
SELECT node AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(seen) AS component_id
FROM r LEFT JOIN n ON node = n.doc_id GROUP BY node""",
    "op6_license_statements": rf"""
WITH t(template_id, text) AS (VALUES {_values(LICENSES)}),
tw AS (SELECT template_id, {_WORDS.format('text')} AS w FROM t),
ts AS (SELECT template_id, power(2, ceil(log2(len(w))))::BIGINT AS stride,
              list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS sh FROM tw),
tu AS (SELECT DISTINCT stride, unnest(sh) AS s FROM ts),
dw AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
ds AS (SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS s,
              unnest(range(0, len(w) - 1)) AS pos FROM dw WHERE len(w) > 1),
dm AS (SELECT doc_id, stride, s, pos // stride AS b FROM ds JOIN tu USING (s)),
win AS (SELECT doc_id, stride, win, list(DISTINCT s) AS sh
        FROM (SELECT *, unnest([b - 1, b]) AS win FROM dm) WHERE win >= 0 GROUP BY ALL),
m AS (SELECT doc_id, template_id, win, len(list_intersect(ts.sh, win.sh)) / len(ts.sh) AS containment
      FROM win JOIN ts USING (stride)),
f AS (SELECT doc_id, string_agg(DISTINCT template_id, ',' ORDER BY template_id) AS licenses,
             max(containment) AS containment, count(*) AS n_windows
      FROM m WHERE containment >= 0.8 GROUP BY doc_id)
SELECT doc_id, coalesce(licenses, '') AS licenses, containment, coalesce(n_windows, 0)::BIGINT AS n_windows
FROM documents LEFT JOIN f USING (doc_id)""",
    "op10_decontaminate": rf"""
WITH iw AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
win AS (SELECT item_id, unnest(CASE WHEN len(w) <= 13 THEN [w]
                                    ELSE list_transform(range(1, len(w) - 11), lambda i: w[i:i + 12]) END) AS ws
        FROM iw WHERE len(w) > 0),
wd AS (SELECT item_id, array_to_string(ws, ' ') AS s, len(ws) AS n FROM win),
dw AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM wd),
dv AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM dw, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, i, dv.n, item_id
        FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM dv) dv JOIN wd USING (n, s)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hit GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op12_quality_rules": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, 'none') AS lang, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
win AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM win JOIN (SELECT r, g FROM win GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
b AS (SELECT d.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             [length(regexp_replace(text, '[^a-z]', '', 'g')), length(regexp_replace(text, '[^A-Z]', '', 'g')),
              length(regexp_replace(text, '[\x00-\x7F]', '', 'g')), length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')),
              length(regexp_replace(text, '[^.,;:!?''"()-]', '', 'g')), length(regexp_replace(text, '[^0-9]', '', 'g'))] AS c,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
             coalesce(rep.n, 0) AS n_repeat_words
      FROM d LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             list_append(c, word_chars - list_sum(c)::BIGINT) AS cl FROM b),
ok AS (SELECT * FROM f WHERE NOT base_failed),
wl AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM ok) GROUP BY ALL),
tot AS (SELECT lang, sum(n) AS total FROM wl GROUP BY lang),
com AS (SELECT lang, word, n / total AS q FROM wl JOIN tot USING (lang) WHERE total >= 10000
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 100),
cls AS (SELECT lang, i, sum(x) AS n, sum(sum(x)) OVER (PARTITION BY lang) AS total
        FROM (SELECT lang, unnest(cl) AS x, generate_subscripts(cl, 1) AS i FROM ok) GROUP BY lang, i),
bins AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM ok) GROUP BY ALL),
pw AS (SELECT ok.r, coalesce(bins.n, 0) / n_words AS p, com.q FROM ok JOIN com USING (lang)
       LEFT JOIN bins ON bins.r = ok.r AND bins.word = com.word WHERE n_words >= 50),
pa AS (SELECT r, 'word' AS kind, p, q FROM pw
       UNION ALL SELECT r, 'word', 1 - sum(p), 1 - sum(q) FROM pw GROUP BY r
       UNION ALL SELECT r, 'class', x / word_chars, cls.n / total
       FROM (SELECT r, lang, word_chars, unnest(cl) AS x, generate_subscripts(cl, 1) AS i FROM ok WHERE word_chars >= 200)
       JOIN cls USING (lang, i) WHERE total >= 10000),
js AS (SELECT r, kind, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                          + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS dist
       FROM pa GROUP BY r, kind),
far AS (SELECT DISTINCT r FROM js WHERE dist > CASE kind WHEN 'word' THEN 0.5 ELSE 0.25 END)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, c[4]::BIGINT AS n_symbols,
       (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND far.r IS NULL AS kept
FROM f LEFT JOIN far USING (r)""",
}
