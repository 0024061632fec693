"""Registered queries of the text operators, each over its whole table, and their SQL where SQL can express them."""

from pyspark.sql import functions as F

QUERIES = {}
ORACLE = {}


def query(name, sql=None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash_near_duplicates")
def op1(spark, sf_dir):
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    from bandlore.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op8_bpe_round_trip")
def op8(spark, sf_dir):
    """doc_id, n_tokens and digests of ids and decoded text of every document."""
    from bandlore.llm.bpe import round_trip_digests

    return round_trip_digests(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6(spark, sf_dir):
    """doc_id, n_bytes, n_tokens, over_limit of every document. Every call starts with an empty cache."""
    from bandlore.llm.token_cache import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


@query("op4_ring_shards")
def op4(spark, sf_dir):
    """Shard and slot of every document on a bounded-load ring without slack: row counts at most one apart."""
    from bandlore.llm.ring import shard

    placed = shard(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


WORDS_SQL = """regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"""


@query("op7_line_quality", f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
  {WORDS_SQL} AS w FROM documents),
win AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) > 3),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i+1], w[i+2]) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) v(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
said AS (SELECT r, l, regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+') AS w FROM lines),
judged AS (SELECT r, l, w, len(w) > 0 AS spoken, (
  len(list_filter(w, lambda x: regexp_matches(x, '!!|\\?\\?|##|\\*\\*|\\$\\$|%%|&&|\\|\\||<<|>>|~~|==|__|\\^\\^|[#*$%&<>~^]$')))
    > 0.3::DOUBLE*len(w)
  OR (len(list_filter(w, lambda x: regexp_matches(x, '^[|»›>·•]+$'))) >= 3
    AND len(list_filter(w, lambda x: regexp_matches(x, '^[|»›>·•]+$'))) >= 0.25::DOUBLE*len(w))
  OR (len(w) <= 30 AND regexp_matches(l, '(?i)\\b(all rights reserved|copyright \\(c\\)|cookie policy|privacy policy|terms of (use|service)|(licensed|released) under|subscribe to our|sign up for|log in to|enable javascript|click here|read more|share this|follow us|skip to content|back to top)\\b'))
  ) AS bad FROM said),
per AS (SELECT r, count(*) FILTER (WHERE spoken) - count(DISTINCT l) FILTER (WHERE spoken) AS dup,
  coalesce(sum(len(w)) FILTER (WHERE NOT bad), 0) AS words_left FROM judged GROUP BY r),
base AS (SELECT doc_id, len(d.w)::BIGINT AS n_words, length(array_to_string(d.w, ''))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines,
  coalesce(cov.n, 0)::BIGINT AS n_repeat_words, words_left FROM d JOIN per USING (r) LEFT JOIN cov USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100*n_repeat_words > 50*n_words AS base_failed,
  NOT (n_words < 50 OR 100*n_repeat_words > 50*n_words) AND words_left >= 0.5::DOUBLE*n_words AS kept FROM base""")
def op7(spark, sf_dir):
    """Base measures and the verdict of line-first cleaning of every document."""
    from bandlore.llm.quality import cleaned

    return cleaned(table(spark, sf_dir, "documents")).drop("text", "words_left")


@query("op5_benchmark_overlap", """WITH
iw AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i+9] AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
  FROM iw WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
  lambda x: x <> '') AS w FROM documents),
sizes AS (SELECT DISTINCT len(win) AS n FROM win),
dw AS (SELECT r, i, n, w[i:i+n-1] AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM dw JOIN win USING (win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
  FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN its USING (r)""")
def op5(spark, sf_dir):
    """Benchmark windows in every document."""
    from bandlore.llm.decontaminate import contaminated

    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op10_repeated_passages")
def op10(spark, sf_dir):
    """Every document without the passages that stand earlier elsewhere, and the removed offsets."""
    from bandlore.llm.repeats import without_repeats

    found = without_repeats(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.start, s.end)), ",")
    return found.select(
        "doc_id", "n_units", "n_removed", "removed_chars", (F.col("n_removed") > 0).alias("has_repeats"),
        spans.alias("removed_spans"), "text")


def remainder(divisor):
    """crc32 of doc_id as text, modulo ``divisor``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query("op2_language_id")
def op2(spark, sf_dir):
    """Language of every document, learned from the documents whose checksum modulo 4 is not 2."""
    from bandlore.llm.language import identify, train

    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    model = train(docs.where(remainder(4) != 2))
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), model, "held_out")


@query("op3_toxicity")
def op3(spark, sf_dir):
    """Toxicity score of every document, learned from the labelled documents whose checksum modulo 3 is not 1."""
    from bandlore.llm.toxicity import scored, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").where(remainder(3) != 1))
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    return scored(docs.select("doc_id", "text", held_out.alias("held_out")), model, "held_out")


@query("op9_personal_data")
def op9(spark, sf_dir):
    """Counts and digest of the pattern spans of every document, and all spans."""
    from bandlore.llm.personal import KINDS, found_spans, train

    docs = table(spark, sf_dir, "documents")
    found = found_spans(docs, train(docs))
    base = F.filter("spans", lambda s: s.base)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s.base & (s.kind == kind))).cast("long").alias(f"n_{kind}")

    counts = [counted(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    """Runs of every document after planting, the run with the most periods, and digests of runs and collapsed text."""
    from bandlore.llm.runs import periodic_runs, with_periods

    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    # Most periods first: length / period compared exactly, by cross products. Ties: smallest start, then period.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(
        r.length.cast("long") * b.period > b.length.cast("long") * r.period, r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").cast("long").alias(name) for name in ("start", "length", "period")],
        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op12_prefix_trie")
def op12(spark, sf_dir):
    """Every node of the trie of rebuilt conversations, with its subtree's totals."""
    from bandlore.llm.prefix_trie import prefix_trie, rebuilt

    return prefix_trie(table(spark, sf_dir, "conversations"), rebuilt)


@query("op13_pitman_yor")
def op13(spark, sf_dir):
    """log10 probability of every document, learned from the documents whose checksum modulo 7 is not 2."""
    from bandlore.llm.pitman_yor import scored

    return scored(table(spark, sf_dir, "documents"), remainder(7) == 2)
