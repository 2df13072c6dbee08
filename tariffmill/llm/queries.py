"""Registered queries of the operators, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffmill.llm import (
    compact, html_extract, linededup, merkle, minhash, mixing, packing, prefixtrie, quality, sketch, suffix,
    toxicity, url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    """The public tokenizer file, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    # the sample of labelled rows is bounded, so its side of the join is small at every size of the corpus
    seen = labels.where(~held_out & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").alias("label"))
    seen = seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(toxicity.MAX_ROWS)
    model = toxicity.learn(docs.select("doc_id", "text").join(F.broadcast(seen), "doc_id"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


#: Production parameters of the mixture.
MIX_WEIGHTS = {
    "domain": {"web": 50, "books": 20, "news": 20, "forums": 10},
    "language": {"en": 60, "de": 20, "fr": 15, "es": 5},
}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 60, 2, 17
MIX_DOMAINS = ["web", "books", "news", "forums"]


def mix_rows(docs: DataFrame) -> DataFrame:
    """Documents with the levels of the mixing tree. A source's domain follows from the number in its name."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    by_number = F.when(number == "", "web")
    for i, name in enumerate(MIX_DOMAINS):
        by_number = by_number.when(F.substring(number, -1, 1).isin(*[str(d) for d in range(10) if d % 4 == i]), name)
    return docs.select(
        F.col("doc_id").cast("long"), by_number.alias("domain"), F.col("lang").alias("language"), F.col("source").alias("origin"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
    )


OP3_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS language, coalesce(source, '') AS origin,
        CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'web'
             WHEN right(source, 1) IN ('0', '4', '8') THEN 'web' WHEN right(source, 1) IN ('1', '5', '9') THEN 'books'
             WHEN right(source, 1) IN ('2', '6') THEN 'news' ELSE 'forums' END AS domain,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
    FROM documents),
leaf AS (
    SELECT domain, language, origin, sum(n_tokens)::HUGEINT AS tokens, 2 * sum(n_tokens)::HUGEINT AS room
    FROM docs GROUP BY ALL),
d AS (
    SELECT domain, sum(room)::HUGEINT AS room,
        CASE domain WHEN 'web' THEN 50 WHEN 'books' THEN 20 WHEN 'news' THEN 20 WHEN 'forums' THEN 10 ELSE 1 END::HUGEINT AS w,
        (SELECT sum(tokens)::HUGEINT * 60 // 100 FROM leaf) AS budget
    FROM leaf GROUP BY domain),
d1 AS (
    SELECT *, coalesce(sum(room) OVER o, 0)::HUGEINT AS room_before, coalesce(sum(w) OVER o, 0)::HUGEINT AS w_before,
        (sum(w) OVER ())::HUGEINT AS w_all
    FROM d WINDOW o AS (ORDER BY room::DOUBLE / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d2 AS (SELECT *, room * (w_all - w_before) <= w * (budget - room_before) AS filled FROM d1),
d3 AS (
    SELECT *, coalesce(sum(room) FILTER (filled) OVER (), 0)::HUGEINT AS room_full, coalesce(sum(w) FILTER (filled) OVER (), 0)::HUGEINT AS w_full
    FROM d2),
dom AS (SELECT domain, CASE WHEN filled THEN room ELSE (w * (budget - room_full)) // nullif(w_all - w_full, 0) END AS budget FROM d3),
l AS (
    SELECT domain, language, sum(room)::HUGEINT AS room,
        CASE language WHEN 'en' THEN 60 WHEN 'de' THEN 20 WHEN 'fr' THEN 15 WHEN 'es' THEN 5 ELSE 1 END::HUGEINT AS w,
        any_value(dom.budget) AS budget
    FROM leaf JOIN dom USING (domain) GROUP BY domain, language),
l1 AS (
    SELECT *, coalesce(sum(room) OVER o, 0)::HUGEINT AS room_before, coalesce(sum(w) OVER o, 0)::HUGEINT AS w_before,
        (sum(w) OVER (PARTITION BY domain))::HUGEINT AS w_all
    FROM l WINDOW o AS (PARTITION BY domain ORDER BY room::DOUBLE / w, language ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l2 AS (SELECT *, room * (w_all - w_before) <= w * (budget - room_before) AS filled FROM l1),
l3 AS (
    SELECT *, coalesce(sum(room) FILTER (filled) OVER p, 0)::HUGEINT AS room_full,
        coalesce(sum(w) FILTER (filled) OVER p, 0)::HUGEINT AS w_full
    FROM l2 WINDOW p AS (PARTITION BY domain)),
lang AS (
    SELECT domain, language, CASE WHEN filled THEN room ELSE (w * (budget - room_full)) // nullif(w_all - w_full, 0) END AS budget
    FROM l3),
s1 AS (
    SELECT domain, language, origin, tokens, room, lang.budget, coalesce(sum(room) OVER o, 0)::HUGEINT AS room_before,
        coalesce(count(*) OVER o, 0)::HUGEINT AS w_before, (count(*) OVER (PARTITION BY domain, language))::HUGEINT AS w_all
    FROM leaf JOIN lang USING (domain, language)
    WINDOW o AS (PARTITION BY domain, language ORDER BY room::DOUBLE, origin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s2 AS (SELECT *, room * (w_all - w_before) <= budget - room_before AS filled FROM s1),
s3 AS (
    SELECT *, coalesce(sum(room) FILTER (filled) OVER p, 0)::HUGEINT AS room_full, count(*) FILTER (filled) OVER p AS w_full
    FROM s2 WINDOW p AS (PARTITION BY domain, language)),
plan AS (
    SELECT domain, language, origin,
        (CASE WHEN filled THEN room ELSE (budget - room_full) // nullif(w_all - w_full, 0) END)::BIGINT AS budget
    FROM s3),
stream AS (
    SELECT doc_id, domain, language, origin, n_tokens, epoch, budget,
        (coalesce(sum(n_tokens) OVER (
            PARTITION BY domain, language, origin ORDER BY epoch, md5('17:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, n_tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS place
    FROM docs JOIN plan USING (domain, language, origin), (SELECT unnest([0, 1])::INTEGER AS epoch))
SELECT doc_id, domain, language, origin, n_tokens::BIGINT AS n_tokens, epoch, place, budget FROM stream
WHERE budget > 0 AND place + n_tokens <= budget
"""


@query("op3_source_mixing", OP3_SQL)
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix_rows(documents(spark, sf_dir))
    return mixing.choose(rows, percent=MIX_PERCENT, max_epochs=MIX_EPOCHS, seed=MIX_SEED, weights=MIX_WEIGHTS)


OP4_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text,
        coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS next_text
    FROM documents WINDOW o AS (ORDER BY doc_id DESC, text)),
edited AS (
    SELECT doc_id, length(text) AS n, text, next_text,
        CASE WHEN length(text) > 1
             THEN left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) ELSE text END AS edited_text
    FROM docs),
parts AS (
    SELECT doc_id, 'a' AS kind, text FROM edited UNION ALL SELECT doc_id, 'e', edited_text FROM edited
    UNION ALL SELECT doc_id, 'n', next_text FROM edited),
words AS (
    SELECT doc_id, kind, list_filter(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM parts),
hashes AS (
    SELECT doc_id, kind, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: left(md5(array_to_string(w[i:i + 4], ' ')), 8)))) END AS h
    FROM words),
kept AS (
    SELECT doc_id, kind, CASE WHEN len(list_filter(h, lambda x: x < '20000000')) >= 32
        THEN list_filter(h, lambda x: x < '20000000') ELSE h[1:32] END AS s
    FROM hashes),
reached AS (
    SELECT doc_id, kind, s, CASE WHEN len(s) < 32 THEN 'g' ELSE greatest(s[len(s)], '20000000') END AS r FROM kept),
sides AS (
    SELECT a.doc_id, a.s AS sa, e.s AS se, n.s AS sn, least(a.r, e.r) AS re, least(a.r, n.r) AS rn
    FROM reached a JOIN reached e ON a.doc_id = e.doc_id AND a.kind = 'a' AND e.kind = 'e'
    JOIN reached n ON a.doc_id = n.doc_id AND n.kind = 'n'),
cut AS (
    SELECT doc_id, sa, se, sn, list_filter(sa, lambda x: x <= re) AS ae, list_filter(se, lambda x: x <= re) AS ee,
        list_filter(sa, lambda x: x <= rn) AS an, list_filter(sn, lambda x: x <= rn) AS nn
    FROM sides)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited_text) AS edited_sha256,
    array_to_string(sa, '') AS fingerprint, array_to_string(se, '') AS edited_fingerprint,
    CASE WHEN len(sa) = 0 AND len(se) = 0 THEN 1.0 WHEN least(len(ae), len(ee)) = 0 THEN 0.0
         ELSE len(list_intersect(ae, ee))::DOUBLE / least(len(ae), len(ee)) END::DOUBLE AS near_edited,
    CASE WHEN len(sa) = 0 AND len(sn) = 0 THEN 1.0 WHEN least(len(an), len(nn)) = 0 THEN 0.0
         ELSE len(list_intersect(an, nn))::DOUBLE / least(len(an), len(nn)) END::DOUBLE AS near_next
FROM cut JOIN edited USING (doc_id)
"""


@query("op4_document_fingerprints", OP4_SQL)
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sketch.fingerprints(documents(spark, sf_dir), size=5, fraction=0.125, floor=32)
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        sketch.fingerprint_text(F.col("sketch")).alias("fingerprint"),
        sketch.fingerprint_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


@query("op5_url_filters")
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "blocked", "probability", "held_out")


@query("op6_minhash_near_dedup")
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), size=2, percent=80)


@query("op7_suffix_array_dedup")
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.drop_repeats(documents(spark, sf_dir), length=100)
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each link from both its ends, so that every document that holds a passage found elsewhere has rows of its own."""
    links = compact.near_passages(documents(spark, sf_dir), words=50, size=5, similarity=0.8)
    sides = ["doc_id", "start", "end"], ["other_id", "other_start", "other_end"]
    ends = [
        F.struct(*[F.col(c).alias(name) for name, c in zip(sides[0] + sides[1], own + other, strict=True)])
        for own, other in (sides, sides[::-1])
    ]
    return links.select("kind", F.explode(F.array(*ends)).alias("link"), "similarity").select("kind", "link.*", "similarity")


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "over_bound")


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


#: CRC-32 of a decimal number's text, bit by bit, as DuckDB has no function for it.
CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _framed_sql(*columns: str) -> str:
    return " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in columns)


OP12_SQL = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, '') AS tree, {_framed_sql('doc_id', 'source', 'lang', 'n_chars')} AS head,
        text, CASE WHEN {CRC_SQL.format('doc_id')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
    FROM documents),
l AS (
    SELECT r, doc_id, tree, sha256(head || {_framed_sql('text')}) AS leaf, sha256(head || {_framed_sql('changed')}) AS claimed FROM d),
p AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
    FROM l),
up(tree, level, idx, h, n) AS (
    SELECT tree, 0, idx, leaf, n FROM p UNION ALL
    SELECT tree, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM up WHERE n > 1
    GROUP BY tree, level, idx // 3, n),
subroots AS (
    SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees FROM up WHERE n = 1),
above(level, idx, h, n) AS (
    SELECT 0, place, subroot, trees FROM subroots UNION ALL
    SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM above WHERE n > 1 GROUP BY level, idx // 3, n),
steps AS (
    SELECT r, up.level, coalesce(string_agg(h, '' ORDER BY up.idx) FILTER (up.idx < p.idx // (3 ** up.level)::BIGINT), '') AS low,
        coalesce(string_agg(h, '' ORDER BY up.idx) FILTER (up.idx > p.idx // (3 ** up.level)::BIGINT), '') AS high
    FROM p JOIN up ON p.tree = up.tree AND up.n > 1 AND up.idx // 3 = p.idx // (3 ** (up.level + 1))::BIGINT GROUP BY r, up.level
    UNION ALL
    SELECT r, 1000 + above.level, coalesce(string_agg(h, '' ORDER BY above.idx) FILTER (above.idx < place // (3 ** above.level)::BIGINT), ''),
        coalesce(string_agg(h, '' ORDER BY above.idx) FILTER (above.idx > place // (3 ** above.level)::BIGINT), '')
    FROM p JOIN subroots USING (tree) JOIN above ON above.n > 1 AND above.idx // 3 = place // (3 ** (above.level + 1))::BIGINT
    GROUP BY r, above.level),
numbered AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY level) AS step FROM steps),
folds(r, step, h) AS (
    SELECT r, 0::BIGINT, claimed FROM l UNION ALL
    SELECT folds.r, numbered.step, sha256(low || h || high) FROM folds JOIN numbered ON numbered.r = folds.r AND numbered.step = folds.step + 1),
folded AS (SELECT r, arg_max(h, step) AS folded_root FROM folds GROUP BY r),
proofs AS (SELECT r, string_agg(low || high, '' ORDER BY step) AS proof FROM numbered GROUP BY r)
SELECT doc_id, leaf, subroot, (SELECT h FROM above WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
    folded_root = (SELECT h FROM above WHERE n = 1) AS verified
FROM p JOIN subroots USING (tree) JOIN folded USING (r) LEFT JOIN proofs USING (r)
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    proved = merkle.document_manifest(documents(spark, sf_dir), tampered)
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP13_SQL = r"""
WITH lines AS (
    SELECT row_number() OVER () AS r, coalesce(doc_id, -9223372036854775808) AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents),
keyed AS (
    SELECT r, d, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT r, d, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM lines)),
shared AS (SELECT key, min(d) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING min(d) < max(d)),
judged AS (SELECT r, line, pos, shared.key IS NOT NULL AND d > first AS dropped FROM keyed LEFT JOIN shared USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged JOIN lines USING (r) GROUP BY r
"""


@query("op13_line_dedup", OP13_SQL)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    index, batch = linededup.insert(None, docs)
    judged = linededup.drop_shared_lines(index, docs, batch)
    return judged.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = f"""
WITH t AS (
    SELECT conv_id, md5(strlen(role) || ':' || role || text) AS h, strlen(text) AS size,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS i
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, {CRC_SQL.format('conv_id')} % 9 AS k FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
    SELECT c.conv_id, t.i, h, size FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.i <= k UNION ALL
    SELECT conv_id, t.i, h, size FROM c JOIN t USING (conv_id) WHERE t.i > k),
p AS (
    SELECT conv_id, d, size, md5(string_agg(h, '' ) OVER (PARTITION BY conv_id ORDER BY d)) AS path
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d FROM r)
    UNION ALL SELECT conv_id, 0, 0, '' FROM c),
nodes AS (SELECT d, path, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size FROM p GROUP BY d, path),
linked AS (
    SELECT nodes.*, up.path AS up_path, above.conv_id AS up_id
    FROM nodes LEFT JOIN p up ON up.conv_id = nodes.conv_id AND up.d = nodes.d - 1
    LEFT JOIN nodes above ON above.d = up.d AND above.path = up.path),
kids AS (SELECT d - 1 AS d, up_path AS path, count(*) AS n_children FROM linked WHERE up_path IS NOT NULL GROUP BY ALL),
full_nodes AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN kids USING (d, path)),
below AS (
    SELECT a.d, a.path, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n - 1) * v.size) AS saved
    FROM full_nodes v JOIN p a ON a.conv_id = v.conv_id AND a.d <= v.d GROUP BY a.d, a.path),
ends AS (
    SELECT d, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM p JOIN (SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id) USING (conv_id, d) GROUP BY d, path)
SELECT conv_id, d AS depth, up_id AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens,
    sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes JOIN below USING (d, path) LEFT JOIN ends USING (d, path)
"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefixtrie.sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"), near=5)
    heads = convs.where("conv_id = base").select("base", F.slice("steps", 1, 8).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    shared = F.slice(F.coalesce("head", F.slice("steps", 1, 0)), F.lit(1), taken)
    own = F.slice("steps", taken + 1, F.greatest(F.size("steps"), F.lit(1)))
    rebuilt = convs.join(heads, "base", "left").select("conv_id", F.concat(shared, own).alias("steps"))
    return prefixtrie.prefix_trie(rebuilt)
