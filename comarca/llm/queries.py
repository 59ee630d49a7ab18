"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.llm import kdtree_topk, language_id, mixing, ordinal_quality, secret_ledger, url_rules
from comarca.llm.alignment import align_documents
from comarca.llm.common import new_path, table
from comarca.llm.divergence import divergence
from comarca.llm.embedding_dedup import near_vectors
from comarca.llm.line_dedup import without_repeated_lines
from comarca.llm.minhash_dedup import near_duplicates
from comarca.llm.sentencepiece_bpe import encode_documents
from comarca.llm.token_files import read_token_digests, write_token_files


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.select(
        "doc_id",
        F.size("pieces.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("pieces.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("pieces.decoded"), 256).alias("decoded_sha256"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token_files")
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, end_id=2)
    return read_token_digests(spark, path)


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_ledger.scan_documents(docs, new_path(spark, "secret_ledger"))
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.sha2(secret_ledger.joined_spans(spans, secret_ledger.BASE), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, secret_ledger.BASE), base, secret_ledger.joined_spans(spans).alias("spans"))


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: The patterns as the contract words them (kind, pattern, group, least length), and the further kinds; said anew here, not taken from the scanner.
OP4_PATTERNS = (
    ("assign", rf"""({"|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", "gh[pousr]_[A-Za-z0-9]{30,}", 0, 34),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 20),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 39),
)


def op4_sql() -> str:
    """Starts are the lengths of what a pattern splits off before a match and of the matches before it."""
    quoted = lambda pattern: pattern.replace("'", "''")
    found = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS k, '{kind}' AS kind, {least} AS least, string_split_regex(t, '{quoted(pattern)}') AS parts, regexp_extract_all(t, '{quoted(pattern)}', 0) AS whole, regexp_extract_all(t, '{quoted(pattern)}', {group}) AS secret FROM d"
        for k, (kind, pattern, group, least) in enumerate(OP4_PATTERNS)
    )
    base = "'assign', 'access', 'hex'"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS ({found}),
    each AS (SELECT *, unnest(generate_series(1, len(whole))) AS i FROM found WHERE len(whole) > 0),
    spans AS (
        SELECT doc_id, k, kind, length(whole[i]) AS n, list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS start
        FROM each WHERE length(secret[i]) >= least),
    told AS (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT) AS span FROM spans)
    SELECT d.doc_id, {counts}, sha256(coalesce(string_agg(span, ',' ORDER BY start, k) FILTER (WHERE kind IN ({base})), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, k), '') AS spans
    FROM d LEFT JOIN told ON told.doc_id = d.doc_id GROUP BY d.doc_id"""


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judged(pages, frequency=url_rules.frequencies(pages)).select("page_id", "host", "path", "rule", "verdict")


def op6_sql() -> str:
    """The contract's rules, longest first, and the pattern rules; said anew here, not taken from the module."""
    low = "coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
    return rf"""
        WITH parts AS (
            SELECT page_id, {low} AS low,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        ruled AS (
            SELECT *, CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                           WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
                           WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                           WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                           WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
                   regexp_matches(low, '(^|[/.])spam-farm\.') OR regexp_matches(low, '(^|[/.])cheap-pills\.') OR regexp_matches(low, '(^|[/.-])casino([/.-]|$)') OR regexp_matches(low, 'free-(money|cash)')
                   OR regexp_matches(low, '(^|[/.-])(porn|xxx)([/.-]|$)') OR regexp_matches(low, '/wp-login\.php') OR regexp_matches(low, '[?&]utm_source=(ads|spam)(&|#|$)') OR regexp_matches(low, '\.(exe|apk|msi)([?#]|$)') AS matched
            FROM parts)
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR matched THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled"""


def op8_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = kdtree_topk.usable(table(spark, sf_dir, "embeddings"))
    found = kdtree_topk.top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


OP8_SQL = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=2, percent=80)


OP9_SQL = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
        FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 2 THEN [ws[1]]
            ELSE list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingle
        FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (
        SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * common >= 80 * (x.n + y.n - common)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
    m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
    FROM w JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)"""


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), cosine=0.93)


OP10_SQL = """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    u AS (SELECT vec_id, label, x, sqrt(list_inner_product(x, x)) AS size FROM v),
    e AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
        WHERE list_inner_product(a.x, b.x) / (a.size * b.size) >= 0.93),
    r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.vec_id),
    m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id),
    l AS (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY a)
    SELECT m.vec_id, coalesce(l.n, 0) AS n_links, component_id, m.vec_id = component_id AS kept
    FROM m LEFT JOIN l USING (vec_id)"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language_id.held_out())
    model = language_id.fit(docs.where(~F.col("held_out")))
    found = language_id.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs)


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 toxic, 1 of low quality, 2 good. Kept: where good is not unlikely."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    rated = docs.join(table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade")), "doc_id")
    found = ordinal_quality.grade_documents(docs, ordinal_quality.fit(rated))
    tail = F.coalesce(F.get("grade.tails", F.lit(1)), F.lit(0.0))
    return found.select("doc_id", F.col("grade.expected").alias("expected_grade"), tail.alias("p_good"), (tail >= ordinal_quality.KEEP).alias("kept"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"), least_documents=30, smoothing=5, scale=10**9, top=50)


OP11_SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents),
    w AS (SELECT row_id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
    size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
    sums AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
    whole AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
    wholes AS (SELECT lang, sum(n) AS total FROM whole GROUP BY ALL),
    p AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * z.v) AS p
        FROM groups g JOIN kept k ON k.lang = g.lang JOIN size z ON z.lang = g.lang
        LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS q FROM whole JOIN wholes USING (lang) JOIN size USING (lang)),
    differ AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pair AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN differ x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
    term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
    WHERE part = 'pair' OR rank <= 50"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), least_length=10, least_documents=2)
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


OP12_SQL = """
    WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT row_id, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    f AS (SELECT key, min(doc_id) AS holder FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
    SELECT k.doc_id, count(*) AS n_lines, count(f.key) FILTER (WHERE k.doc_id <> f.holder) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL OR k.doc_id = f.holder), '')) AS kept_sha256
    FROM k LEFT JOIN f ON k.key = f.key GROUP BY row_id, k.doc_id"""


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_language_id": op2_language_id,
        "op3_token_files": op3_token_files,
        "op4_secret_ledger": op4_secret_ledger,
        "op5_mixing": op5_mixing,
        "op6_url_rules": op6_url_rules,
        "op7_ordinal_quality": op7_ordinal_quality,
        "op8_kdtree_topk": op8_kdtree_topk,
        "op9_minhash_dedup": op9_minhash_dedup,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_source_divergence": op11_source_divergence,
        "op12_line_dedup": op12_line_dedup,
        "op13_token_alignment": op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_secret_ledger": op4_sql(), "op6_url_rules": op6_sql(), "op8_kdtree_topk": OP8_SQL, "op9_minhash_dedup": OP9_SQL, "op10_embedding_dedup": OP10_SQL, "op11_source_divergence": OP11_SQL, "op12_line_dedup": OP12_SQL}
