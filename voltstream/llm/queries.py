"""The dealt operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.collocations import collocations
from voltstream.llm.common import prepared, text_or_empty
from voltstream.llm.embeddings import near_duplicates
from voltstream.llm.fingerprints import PARAGRAPH, PHRASE, SECTION, compare_with_edit
from voltstream.llm.interactions import interaction_audit
from voltstream.llm.jaccard import jaccard_join
from voltstream.llm.licenses import scan_licenses
from voltstream.llm.mixing import mix
from voltstream.llm.packing import pack
from voltstream.llm.quality import quality
from voltstream.llm.sharding import LAW, document_size, shard_documents
from voltstream.llm.tokens import count_tokens
from voltstream.llm.toxicity import toxicity
from voltstream.llm.warc import capture_index

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edit(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pack(documents, public_tokenizers.path(TOKENIZER))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licenses(table(spark, sf_dir, "documents"))
    spans = F.transform(
        "notices", lambda n: F.concat_ws(":", n["label"], F.concat_ws("-", n["start"], n["end"]), n["edits"])
    )
    return scanned.withColumn("notices", F.array_join(spans, ","))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return count_tokens(documents, public_tokenizers.path(TOKENIZER))


def op8_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = capture_index(table(spark, sf_dir, "pages"))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured_at"
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return scored.select(
        "doc_id", "held_out", "score", "predicted", F.array_join(spans, ",").alias("toxic_spans")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    size, crc32 = document_size(F.col("text")).alias("size"), F.crc32(text_or_empty("text")).alias("text_crc32")
    sharded = shard_documents(documents.select("*", size, crc32))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return sharded.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", grown)


QUERIES: dict[str, Query] = {
    "op1_document_fingerprints": op1_document_fingerprints,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_license_scan": op4_license_scan,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_source_mixing": op6_source_mixing,
    "op7_token_counts": op7_token_counts,
    "op8_warc_captures": op8_warc_captures,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_filter_interactions": op12_filter_interactions,
    "op13_sharding": op13_sharding,
}


def _merkle_sql(text: str) -> str:
    """Fingerprint of a text column, as SQL."""
    tree = (
        f"list_transform(regexp_extract_all({text}, '{SECTION}'), lambda s: "
        f"list_transform(regexp_extract_all(s, '{PARAGRAPH}'), lambda p: "
        f"list_transform(regexp_extract_all(p, '{PHRASE}'), lambda x: sha256(x))))"
    )
    root = (
        f"sha256(concat_ws('', array_to_string(list_transform({tree}, lambda s: sha256(concat_ws('', "
        "array_to_string(list_transform(s, lambda p: sha256(array_to_string(p, ''))), '')))), '')))"
    )
    short = (
        f"array_to_string(list_transform({tree}, lambda s: array_to_string(list_transform(s, lambda p: "
        "array_to_string(list_transform(p, lambda x: substr(x, 1, 6)), '')), '.')), '/')"
    )
    return f"{root} || ':' || coalesce({short}, '')"


def _likeness_sql(left: str, right: str) -> str:
    a, b = (f"regexp_extract_all(split_part({c}, ':', 2), '[0-9a-f]{{6}}')" for c in (left, right))

    def share(of: str) -> str:
        x, y = (f"list_distinct({of.format(p)})" for p in (a, b))
        return f"coalesce(2.0::DOUBLE * len(list_intersect({x}, {y})) / nullif(len({x}) + len({y}), 0), 0.0::DOUBLE)"

    pairs = "list_transform(list_zip(list_concat([''], {0}), list_concat({0}, [''])), lambda z: z[1] || '>' || z[2])"
    most = f"1 - 1.0::DOUBLE / (len({a}) + len({b}) + 1)"
    return f"CASE WHEN {left} = {right} THEN 1.0::DOUBLE ELSE least(({share('{}')} + {share(pairs)}) / 2, {most}) END"


def _changed_sql(left: str, right: str) -> str:
    a, b = (f"string_split(split_part({c}, ':', 2), '/')" for c in (left, right))
    own = f"list_filter({a}, lambda s: NOT list_contains({b}, s))"
    own, other = (f"flatten(list_transform({x}, lambda s: string_split(s, '.')))" for x in (own, b))
    return f"len(list_distinct(list_filter({own}, lambda p: NOT list_contains({other}, p))))"


ORACLE: dict[str, str] = {
    "op1_document_fingerprints": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        n AS (
            SELECT doc_id, text, coalesce(
                lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)
            ) AS next FROM d),
        e AS (
            SELECT *, substr(text, 1, length(text) - length(text) // 3)
                || substr(next, 1, length(text) // 3) AS edited FROM n),
        f AS (
            SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
                {_merkle_sql("text")} AS fingerprint, {_merkle_sql("edited")} AS edited_fingerprint,
                {_merkle_sql("next")} AS next_fingerprint FROM e)
        SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
            {_likeness_sql("fingerprint", "edited_fingerprint")} AS near_edited,
            {_likeness_sql("fingerprint", "next_fingerprint")} AS near_next,
            {_changed_sql("fingerprint", "edited_fingerprint")} AS changed
        FROM f
    """,
    "op5_ngram_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^ \\t-\\r]+') AS w FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
            FROM w),
        x AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
        linked AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reached(doc_id, node) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, l.b FROM reached r JOIN linked l ON r.node = l.a)
        SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id
        FROM s JOIN (SELECT doc_id, min(node) AS component_id FROM reached GROUP BY doc_id) c USING (doc_id)
    """,
    "op6_source_mixing": """
        WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        r AS (
            SELECT source, sqrt(n) * ((SELECT sum(n) FROM c) / (SELECT sum(sqrt(n)) FROM c)) / n AS rate FROM c),
        m AS (SELECT source, ceil(rate / 8)::INT AS draws, rate / ceil(rate / 8) AS mean FROM r),
        p AS (
            SELECT source, k, exp(k * ln(mean) - mean - lgamma(k + 1)) AS p
            FROM m, (SELECT unnest(range(0, 65)) AS k)),
        d AS (
            SELECT source, list(c ORDER BY k) AS cdf FROM (
                SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p) GROUP BY source),
        x AS (
            SELECT doc_id, text, lang, n_chars, m.source, cdf, unnest(range(1, draws + 1)) AS draw
            FROM documents JOIN m ON documents.source IS NOT DISTINCT FROM m.source
            JOIN d ON m.source IS NOT DISTINCT FROM d.source),
        u AS (
            SELECT doc_id, text, lang, n_chars, source, sum(len(list_filter(cdf, lambda c: c <= number))) AS copies FROM (
                SELECT *, ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null') || '|' || draw), 1, 13))::BIGINT
                    / 4503599627370496.0::DOUBLE AS number FROM x)
            GROUP BY doc_id, text, lang, n_chars, source),
        e AS (SELECT doc_id, text, lang, n_chars, source, unnest(range(0, copies::BIGINT)) AS copy FROM u)
        SELECT doc_id, text, lang, n_chars, source, copy, ('0x' || substr(
            md5('mix|place|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy), 1, 15))::BIGINT AS position
        FROM e
    """,
    "op8_warc_captures": """
        WITH p AS (
            SELECT page_id, lower(url) AS url, strlen(coalesce(html, '')) AS payload_bytes,
                sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (
            SELECT *, CASE WHEN payload_bytes >= 100
                THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to,
            array_to_string(list_reverse(string_split(
                regexp_replace(regexp_extract(url, '://([^/?#]+)', 1), '^www[.]', ''), '.')), ',')
                || ')' || regexp_extract(url, '://[^/?#]+([^#]*)', 1) AS urlkey,
            strftime(make_timestamp((1700000000 + page_id % 268435456) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
        FROM f
    """,
    "op11_phrase_collocations": """
        WITH d AS (
            SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
        w AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM p),
        f AS (
            SELECT lang, phrase, k, count(*) AS a FROM (
                SELECT lang, k, unnest(list_transform(
                    range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
                FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
            GROUP BY ALL),
        n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
        cut AS (
            SELECT lang, phrase, a, k, w, unnest(range(1, k)) AS j FROM c),
        s AS (
            SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r,
                (2000000::HUGEINT * cut.a // (x.a + y.a))::BIGINT AS score
            FROM cut
            JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1:j], ' ')
            JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[j + 1:], ' ')),
        weakest AS (
            SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        covered AS (
            SELECT DISTINCT c.lang, c.phrase FROM c JOIN c b ON b.lang = c.lang AND b.k > c.k
                AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * b.a >= 80 * c.a)
        SELECT weakest.lang, rank, phrase, a, l, r, n, score FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM weakest ANTI JOIN covered USING (lang, phrase)) weakest
        JOIN n USING (lang) WHERE rank <= 2000
    """,
    "op12_filter_interactions": """
        WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^ \\t-\\r]+') AS w FROM d),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        m AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
                || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
            FROM w LEFT JOIN l USING (doc_id)),
        orders(filter_order) AS (
            SELECT '' UNION ALL
            SELECT filter_order || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x)
            WHERE NOT contains(filter_order, x)),
        steps AS (
            SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
                substr(filter_order, 1, step - 1) AS earlier
            FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step) WHERE length(filter_order) = 5),
        k AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM m GROUP BY part, fails),
        x AS (
            SELECT part, filter_order, step, letter, n, good, toxic, fails,
                earlier <> '' AND regexp_matches(fails, '[' || earlier || '-]') AS gone, contains(fails, letter) AS hit
            FROM k, steps),
        t AS (
            SELECT part, filter_order, step, letter,
                sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept,
                sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END)::BIGINT AS removed,
                sum(CASE WHEN gone AND hit THEN n ELSE 0 END)::BIGINT AS redundant,
                sum(CASE WHEN fails = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
                sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END)::BIGINT AS good_lost,
                sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
            FROM x GROUP BY part, filter_order, step, letter)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
        FROM t
    """,
}
