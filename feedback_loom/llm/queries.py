"""One query per operator, over whole tables and with production parameters."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    decontaminate, embed_dedup, lexical_search, license_scan, line_dedup, lm_scoring, minhash, packing, periodic_runs,
    sentencepiece_codec, token_counts, toxicity, url_filters, vocabularies,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(n: int) -> Column:
    """crc32 of the document's id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the blocks of lines, and the passages inside lines, that an earlier document holds."""
    done = line_dedup.deduplicated(table(spark, folder, "documents"))
    return done.select("doc_id", "text", "n_removed", "removed_spans")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents by a model of the labelled ones that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    model = toxicity.trained(docs.where(~held_out), table(spark, folder, "labels").where(remainder(5) != 0))
    found = toxicity.scored(docs.withColumn("held_out", held_out), model)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents under word counts and the pair model of six sevenths of them."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(7) == 2, F.lit(False))
    model = lm_scoring.trained(docs.where(~held_out))
    found = lm_scoring.scored(docs, model, extra={"held_out": held_out})
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                        "base_score", "score")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document, from one encoding of the whole text."""
    return token_counts.section_tokens(table(spark, folder, "documents"), vocabularies.path("byte_bpe_50k.tiktoken"),
                                       vocabularies.pattern())


URL_RULES = """VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')"""


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page."""
    rules = spark.sql(f"SELECT * FROM {URL_RULES} AS rules(host, path, verdict)")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filters.judged(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-duplicate documents over shingles of four words at 0.8."""
    return minhash.near_duplicates(table(spark, folder, "documents"), k=4)


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents, with the best window of each."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95."""
    return embed_dedup.near_vectors(table(spark, folder, "embeddings"))


def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and templates found in every document."""
    return license_scan.scanned(table(spark, folder, "documents")).drop("places")


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document, and whether decoding gives the text again."""
    path = vocabularies.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = sentencepiece_codec.decoded(sentencepiece_codec.encoded(docs, path), path)
    return found.select("doc_id", "ids", F.size("ids").alias("n_tokens"), (F.col("decoded") == F.col("text")).alias("round_trip"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, some of them planted by rule, and digests of all runs and of the collapsed text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs.with_runs(periodic_runs.with_planted_repeats(docs))
    best = F.col("best")
    return found.withColumn("best", periodic_runs.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.listing(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token pieces, packed into sequences of at most 4096 tokens."""
    found = packing.packed(table(spark, folder, "documents"), vocabularies.path("word_bpe_49k.json"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_toxicity, op3_lm_scoring, op4_token_counts, op5_url_filters, op6_minhash_near_dedup,
    op7_benchmark_decontamination, op8_embedding_near_dedup, op9_license_scans, op10_sentencepiece, op11_periodic_runs, op12_ranked_search, op13_best_fit_packing,
)}

ORACLES: dict[str, str] = {
    "op5_url_filters": f"""
        WITH rules(rh, rp, verdict) AS ({URL_RULES}),
        urls AS (SELECT page_id,
                translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        best AS (SELECT host, path, arg_max({{'rule': rh || rp, 'verdict': verdict}}, length(rh || rp)) AS best
            FROM (SELECT DISTINCT host, path FROM urls), rules
            WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
        SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
        FROM urls LEFT JOIN best USING (host, path)""",
    "op6_minhash_near_dedup": """
        WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4
                THEN [array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)]
                WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b
                ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id, doc_id AS other FROM documents UNION
                SELECT doc_id, b FROM reach JOIN both_ways ON other = a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)""",
    "op8_embedding_near_dedup": """
        WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL
                AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
                AND len([x for x in embedding if x <> 0]) > 0),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
                ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
        reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT vec_id, b FROM reach JOIN links ON other = a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
        LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)""",
    "op12_ranked_search": """
        WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
        lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
        wanted AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
        weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
                FROM counts, totals GROUP BY term, docs),
        scores AS (SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf)
                    // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words))))::BIGINT AS score
                FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
                GROUP BY item_id, doc_id)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20""",
}
