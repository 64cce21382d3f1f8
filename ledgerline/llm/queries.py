"""Registered queries of this subpackage and their SQL, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import piece_bpe
from ledgerline.llm.common import documents
from ledgerline.llm.exact_dedup import dedup_groups
from ledgerline.llm.jaccard_join import linked_groups
from ledgerline.llm.kmeans_tree import nearest
from ledgerline.llm.merkle import folded, leaf_digest, manifest, path_digest, proofs
from ledgerline.llm.ngram_lm import score_documents
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.periodic_runs import find_runs
from ledgerline.llm.quality_rules import score_quality, train
from ledgerline.llm.sharding import byte_shards
from ledgerline.llm.substring_dedup import remove_repeats
from ledgerline.llm.url_filter import judge_urls
from ledgerline.llm.word_bpe import digests, encode_documents

#: (host, path, verdict) of the rules that the URL query judges by.  Fixed values.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_kmeans_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=20, k=20)


def _remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


def op2_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = train(docs, labels.where(_remainder(5) != 0))
    return score_quality(docs, model).select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", "predicted")


def op3_ngram_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = score_documents(docs, _remainder(7) != 2)
    return scored.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = byte_shards(documents(spark, sf_dir), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_groups(documents(spark, sf_dir), size=5, percent=80)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), length=35).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_documents(documents(spark, sf_dir)))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(piece_bpe.encode_documents(documents(spark, sf_dir)))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.col("doc_id").isNotNull() & (_remainder(5) == 0), lowered).otherwise(F.col("text"))
    other = leaf_digest([tampered if c == "text" else F.col(c) for c in fields])
    proved = proofs(manifest(documents(spark, sf_dir), fields, keep={"other": other}))
    return proved.select(
        F.col("_id").alias("doc_id"), "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("other"), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _made_periodic(text: str, number: str):
    """Every tenth text with its words from a certain one on repeated with a certain period; others as they are."""
    return F.expr(rf"""
        CASE WHEN {number} % 10 = 0 THEN
            transform(array(filter(split({text}, '[\\x20\\x09-\\x0D]+'), x -> x <> '')), w ->
                CASE WHEN size(w) = 0 THEN '' ELSE array_join(transform(
                    array(struct({number} div 10 % size(w) AS a,
                                 1 + (size(w) - {number} div 10 % size(w)) div (3 + {number} div 10 % 8) AS p)),
                    s -> array_join(transform(w, (x, i) -> w[cast(if(i < s.a, i, s.a + (i - s.a) % s.p) AS int)]), ' ')), '') END)[0]
        ELSE {text} END""")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                                           F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("number"))
    found = find_runs(docs.select("doc_id", _made_periodic("text", "number").alias("text")), least=6, times=4)
    best = F.expr("""aggregate(runs, cast(null AS struct<start: bigint, length: bigint, period: bigint>),
                               (b, r) -> CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)""")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_kmeans_tree_search, op2_rule_quality, op3_ngram_trie_scores, op4_byte_shards, op5_url_rules, op6_jaccard_join,
        op7_exact_dedup, op8_substring_dedup, op9_word_bpe, op10_best_fit_packing, op11_piece_bpe,
        op12_merkle_manifest, op13_periodic_runs,
    )
}

#: Common table expressions: crc(doc_id, x), the CRC-32 of the decimal ids of ``documents``, bit by bit.
CRC_OF_ID = r"""        bits(doc_id, rest, x, b) AS (
            SELECT doc_id, doc_id::VARCHAR, 4294967295::BIGINT, 0 FROM documents
            UNION ALL
            SELECT doc_id, CASE WHEN b = 0 THEN rest[2:] ELSE rest END,
                   CASE WHEN b = 0 THEN CASE WHEN xor(x, ascii(rest)::BIGINT) % 2 = 1 THEN xor(xor(x, ascii(rest)::BIGINT) >> 1, 3988292384) ELSE xor(x, ascii(rest)::BIGINT) >> 1 END
                        WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
                   (b + 1) % 8
            FROM bits WHERE b > 0 OR rest <> ''),
        crc AS MATERIALIZED (SELECT doc_id, xor(x, 4294967295) AS x FROM bits WHERE b = 0 AND rest = ''),"""

ORACLE: dict[str, str] = {
    "op5_url_rules": r"""
        WITH u AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
            FROM pages),
        r(rhost, rpath, rverdict) AS (VALUES
            ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        m AS (
            SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
            FROM u LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
        SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE k = 1
    """,
    "op6_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w
            FROM documents),
        s AS MATERIALIZED (
            SELECT DISTINCT doc_id, md5_number(array_to_string(w[i : i + 4], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS MATERIALIZED (
            SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(doc_id, c) AS (
            SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
    """,
    "op8_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w
            FROM documents),
        k AS (
            SELECT doc_id, s, md5(array_to_string(w[s : s + 34], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d)),
        r AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY h) AS c FROM k) WHERE c > 1),
        g AS (SELECT DISTINCT doc_id, s + unnest(range(0, 35)) AS p FROM r),
        gone AS (SELECT doc_id, list(p) AS ps FROM g GROUP BY doc_id),
        kept AS (
            SELECT d.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed, w, ps FROM d LEFT JOIN gone USING (doc_id)),
        flat AS (
            SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM kept),
        stay AS (
            SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM flat ANTI JOIN g USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, n_words, n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM kept LEFT JOIN stay USING (doc_id)
    """,
    "op7_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS n
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY n) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS kept,
               sha256(n) AS text_sha256
        FROM d
    """,
    "op12_merkle_manifest": r"""
        WITH RECURSIVE f AS (
            SELECT doc_id, source, text,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
            FROM documents),
        d AS MATERIALIZED (
            SELECT doc_id, source, text, head, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM f),
        places AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
        t(g, lvl, i, n, h) AS (
            SELECT g, 0, i, n, leaf FROM places
            UNION ALL
            SELECT g, lvl + 1, i // 16, max(n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY g, lvl, i // 16),
        tree AS MATERIALIZED (SELECT * FROM t),
        subroots AS MATERIALIZED (SELECT g, lvl, h, count(*) OVER () AS n FROM tree WHERE n = 1),
        u(lvl, i, n, h) AS (
            SELECT 0, g, n, h FROM subroots
            UNION ALL
            SELECT lvl + 1, i // 16, max(n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lvl, i // 16),
        top AS MATERIALIZED (SELECT * FROM u),
        steps AS (  -- the runs that lead from each leaf to the root; levels of the upper tree from 1000 on
            SELECT p.g, p.i AS place, t.lvl, t.i, t.h, t.i = p.i // (16 ** t.lvl)::BIGINT AS own
            FROM places p JOIN tree t ON t.g = p.g AND t.n > 1 AND t.i // 16 = p.i // (16 ** (t.lvl + 1))::BIGINT
            UNION ALL
            SELECT p.g, p.i, 1000 + u.lvl, u.i, u.h, u.i = p.g // (16 ** u.lvl)::BIGINT
            FROM places p JOIN top u ON u.n > 1 AND u.i // 16 = p.g // (16 ** (u.lvl + 1))::BIGINT),
        segments AS MATERIALIZED (
            SELECT g, place, row_number() OVER (PARTITION BY g, place ORDER BY lvl) AS k,
                   coalesce(string_agg(h, '' ORDER BY i) FILTER (NOT own), '') AS others,
                   coalesce(string_agg(h, '' ORDER BY i) FILTER (i < mine), '') AS before,
                   coalesce(string_agg(h, '' ORDER BY i) FILTER (i > mine), '') AS after
            FROM (SELECT *, max(i) FILTER (own) OVER (PARTITION BY g, place, lvl) AS mine FROM steps) GROUP BY g, place, lvl),
""" + CRC_OF_ID + r"""
        fold(g, place, k, h) AS (
            SELECT g, i, 0, CASE WHEN crc.x % 5 = 0
                                 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
                                 ELSE leaf END
            FROM places JOIN crc USING (doc_id)
            UNION ALL
            SELECT s.g, s.place, s.k, sha256(s.before || fold.h || s.after)
            FROM fold JOIN segments s ON s.g = fold.g AND s.place = fold.place AND s.k = fold.k + 1),
        proof AS (SELECT g, place, sha256(string_agg(others, '' ORDER BY k)) AS proof_sha256 FROM segments GROUP BY g, place),
        ends AS (SELECT g, place, arg_max(h, k) AS folded_root FROM fold GROUP BY g, place)
        SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
               e.folded_root, e.folded_root = r.h AS verified
        FROM places p JOIN subroots s USING (g) JOIN ends e ON e.g = p.g AND e.place = p.i
        LEFT JOIN proof q ON q.g = p.g AND q.place = p.i CROSS JOIN (SELECT h FROM top WHERE n = 1) r
    """,
    "op13_periodic_runs": r"""
        WITH RECURSIVE """ + CRC_OF_ID + r"""
        d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents),
        g AS (SELECT doc_id, w, len(w) AS n, x // 10 AS g, x % 10 = 0 AND len(w) > 0 AS made FROM d JOIN crc USING (doc_id)),
        p AS (SELECT *, CASE WHEN made THEN g % n END AS a, CASE WHEN made THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM g),
        words AS MATERIALIZED (
            SELECT doc_id, n, i, w[1 + CASE WHEN made AND i >= a THEN a + (i - a) % p ELSE i END] AS x
            FROM (SELECT *, unnest(range(n)) AS i FROM p)),
        fives AS MATERIALIZED (
            SELECT * FROM (
                SELECT doc_id, n, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s
                FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE s IS NOT NULL),
        same AS (  -- five words that come again q words later; a run of length >= max(6, 4 q) is a row of them
            SELECT x.doc_id, x.i, y.i - x.i AS q FROM fives x JOIN fives y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
        rows_of AS (
            SELECT doc_id, q, min(i) AS start, max(i) + 5 + q - min(i) AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM same) GROUP BY doc_id, q, k),
        runs AS MATERIALIZED (
            SELECT doc_id, start, length, min(q) AS period FROM rows_of WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
        best AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS k FROM runs),
        total AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s
            FROM runs GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS s FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
               sha256(coalesce(t.s, '')) AS runs_sha256, sha256(coalesce(k.s, '')) AS collapsed_sha256
        FROM d LEFT JOIN total t USING (doc_id) LEFT JOIN best b ON b.doc_id = d.doc_id AND b.k = 1 LEFT JOIN kept k ON k.doc_id = d.doc_id
    """,
}
