"""The queries of the text operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm import (bit_whitening, bitmap_bpe, bwt_dedup, chosen_path, factor_quality, feistel_shards, html_tree, lexical_packing,
                           line_rules, merkle_manifest, secret_links, simhash_trie, stream_dedup)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_factor_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = factor_quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = factor_quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", factor_quality.held_out(F.col("doc_id")).alias("held_out"), F.col("fm_score").alias("score"),
                         (F.col("fm_score") >= 0.5).cast("int").alias("predicted"))


def op2_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_links.scan(table(spark, sf_dir, "documents"))

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", p["kind"], p["start"], p["end"])), ",")

    def many(rank: int) -> Column:
        return F.size(F.filter("spans", lambda p: p["rank"] == rank)).cast("bigint")

    base = F.filter("spans", lambda p: p["rank"] < len(secret_links.STRONG))
    return found.select("doc_id", *[many(i).alias(f"n_{kind}") for i, kind in enumerate(secret_links.STRONG)],
                        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op3_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_dedup.flagged(stream_dedup.groups(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("_digest")).alias("text_sha256"))


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def op4_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt_dedup.remove(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                        # A cut can part the bytes of a character; what is left of it shows as U+FFFD.
                        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op5_sql() -> str:
    gap, word = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)", r"[^\x20\x09-\x0D]"
    symbols = line_rules.SYMBOLS
    ended = line_rules.ENDED.replace("'", "''")
    menu = line_rules.MENU_LINES - 1
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{word}+') AS ws FROM d),
wins AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(ws[i:i + 7], ' ')) AS c
         FROM w, unnest(generate_series(1, len(ws) - 7)) g(i)),
cov AS (SELECT rid, CAST(sum(step) AS BIGINT) AS n FROM (SELECT rid, least(8, coalesce(
            lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS step FROM wins WHERE c > 1) x GROUP BY rid),
lines AS (SELECT rid, ord, line, lead(line) OVER (PARTITION BY rid ORDER BY ord) AS following, regexp_matches(line, '{ended}') AS ended,
            len(regexp_extract_all(line, '{word}+')) AS n, length(translate(line, {gap}, '')) AS size,
            length(line) - length(translate(line, '{symbols}', '')) AS loads, len(regexp_extract_all(line, '{line_rules.SEPARATORS}')) AS seps
          FROM (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS ord FROM (SELECT rid, string_split(t, chr(10)) AS ls FROM d) x) l
          WHERE regexp_matches(line, '{word}')),
starts AS (SELECT *, count(*) FILTER (n <= {line_rules.ITEM_WORDS} AND NOT ended) OVER (
            PARTITION BY rid ORDER BY ord ROWS BETWEEN CURRENT ROW AND {menu} FOLLOWING) = {line_rules.MENU_LINES} AS starts FROM lines),
judged AS (SELECT *, (n >= {line_rules.LONG_WORDS} AND NOT ended AND NOT coalesce(regexp_matches(following, '{line_rules.GOES_ON}'), false))
            OR loads * 2 > n OR (seps >= 2 AND seps * 4 >= n)
            OR (n <= {line_rules.BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{line_rules.PHRASE}'))
            OR bool_or(starts) OVER (PARTITION BY rid ORDER BY ord ROWS BETWEEN {menu} PRECEDING AND CURRENT ROW) AS bad FROM starts),
per AS (SELECT rid, count(*) - count(DISTINCT line) AS dup, coalesce(sum(size) FILTER (bad), 0) AS lost FROM judged GROUP BY rid),
m AS (SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(t) - length(translate(t, '{symbols}', '')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
        coalesce(lost, 0) AS lost FROM w LEFT JOIN cov USING (rid) LEFT JOIN per USING (rid)),
f AS (SELECT *, n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND lost <= {line_rules.MAX_LOST}::DOUBLE * word_chars AS kept FROM f"""


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "class_size")


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM d, unnest(generate_series(1, greatest(len(ws) - 4, 1))) t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
c AS (SELECT node, min(root) AS class_id, count(*) AS class_size FROM r GROUP BY 1),
k AS (SELECT a, count(*) AS n_links FROM e GROUP BY 1)
SELECT node AS doc_id, class_id, coalesce(n_links, 0) AS n_links, class_size FROM c LEFT JOIN k ON a = node"""


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_bitmap_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmap_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                 public_tokenizers.PATTERN)


def op9_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract(table(spark, sf_dir, "pages"))


def op11_bit_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = bit_whitening.fit(rows)
    white = bit_whitening.whiten(rows.select("vec_id", "embedding"), model)
    explained = F.array(*[F.lit(float(v / model.total)) for v in model.values]).cast("array<double>")
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def op12_merkle_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    others = [docs[c] for c in merkle_manifest.FIELDS[:-1]]
    tampered = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0, F.lit(False)) & docs["text"].contains("\n")
    rows = docs.select("doc_id", "source", merkle_manifest.leaf([*others, docs["text"]]).alias("sound"),
                       F.when(tampered, merkle_manifest.leaf([*others, F.replace(docs["text"], F.lit("\n"), F.lit(""))])).alias("changed"))
    proofs = merkle_manifest.build(rows, F.col("sound")).proofs()
    folded = proofs.withColumn("folded_root", merkle_manifest.fold(F.coalesce("changed", "leaf"), F.col("siblings")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle_manifest.proof_text(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.classes(table(spark, sf_dir, "documents"))


def _op12_sql() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"

    # CRC-32 of the decimal digits, bit by bit.
    steps = "list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])))"
    crc = f"xor(list_reduce({steps}, lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT)"
    return f"""
WITH RECURSIVE hashed AS (SELECT doc_id, source, {leaf('text')} AS leaf,
        CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS claimed FROM documents),
leaves AS (SELECT *, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM hashed
        WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
low AS (SELECT source, 0 AS level, place, leaf AS node, n FROM leaves
        UNION ALL SELECT source, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3
        FROM low WHERE n > 1 GROUP BY source, level, place // 3, n),
subs AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (SELECT 0 AS level, place, subroot AS node, n FROM subs
        UNION ALL SELECT level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3
        FROM high WHERE n > 1 GROUP BY level, place // 3, n),
lowruns AS (SELECT source, level, place // 3 AS run, list(node ORDER BY place) AS l FROM low WHERE n > 1 GROUP BY source, level, place // 3),
highruns AS (SELECT level, place // 3 AS run, list(node ORDER BY place) AS l FROM high WHERE n > 1 GROUP BY level, place // 3),
climb AS (SELECT doc_id, source, leaf, 0 AS level, place, claimed AS folded, '' AS proof FROM leaves
        UNION ALL SELECT doc_id, c.source, leaf, c.level + 1, place // 3,
            sha256(array_to_string(l[:place % 3] || [folded] || l[place % 3 + 2:], '')), proof || array_to_string(l[:place % 3] || l[place % 3 + 2:], '')
        FROM climb c JOIN lowruns r ON r.source IS NOT DISTINCT FROM c.source AND r.level = c.level AND r.run = c.place // 3),
ended AS (SELECT *, max(level) OVER (PARTITION BY source) AS last FROM climb),
over AS (SELECT doc_id, leaf, subroot, 0 AS level, s.place, folded, proof FROM ended e JOIN subs s ON s.source IS NOT DISTINCT FROM e.source
            WHERE level = last
        UNION ALL SELECT doc_id, leaf, subroot, c.level + 1, place // 3,
            sha256(array_to_string(l[:place % 3] || [folded] || l[place % 3 + 2:], '')), proof || array_to_string(l[:place % 3] || l[place % 3 + 2:], '')
        FROM over c JOIN highruns r ON r.level = c.level AND r.run = c.place // 3)
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified
FROM over JOIN high ON high.n = 1 WHERE over.level = (SELECT max(level) FROM over)"""


QUERIES = {
    "op1_factor_quality": op1_factor_quality,
    "op2_secret_links": op2_secret_links,
    "op3_stream_dedup": op3_stream_dedup,
    "op4_bwt_dedup": op4_bwt_dedup,
    "op5_line_rules": op5_line_rules,
    "op6_chosen_path": op6_chosen_path,
    "op7_feistel_shards": op7_feistel_shards,
    "op8_bitmap_bpe": op8_bitmap_bpe,
    "op9_lexical_packing": op9_lexical_packing,
    "op10_html_tree": op10_html_tree,
    "op11_bit_whitening": op11_bit_whitening,
    "op12_merkle_checkpoints": op12_merkle_checkpoints,
    "op13_simhash_trie": op13_simhash_trie,
}

ORACLES = {
    "op3_stream_dedup": OP3_SQL,
    "op5_line_rules": _op5_sql(),
    "op6_chosen_path": OP6_SQL,
    "op12_merkle_checkpoints": _op12_sql(),
}
