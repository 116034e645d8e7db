"""Every operator as a query over the test tables: ``name -> f(spark, folder)``.

Answers of a model are derived from the tables themselves (``*_answers``), so each
query reads whole tables and its work grows with them.
"""

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .backends import OfflineBackend, induce_lexicon, lexicon_scores
from .backends.base import LabelSet
from .backends.calling import CallableBackend, asker
from .functions import answers as A, columns as C
from .functions.tokens import term_rows, with_tokens
from .operators import batching, causes, clusters, conclusion, hints, labels, picks, protocol, rollup, state, vectors
from .operators.numbering import numbered
from .plans import analyze
from .session import BROADCAST_ROWS, cut, join_sized, scratch_path, to_table
from .sources import texts as S

EXTRA_CLUSTERS = 5


# ---- inputs -----------------------------------------------------------------

def documents(spark: SparkSession, folder: str) -> DataFrame:
    return S.texts_from(spark.read.parquet(f"{folder}/documents.parquet"), "text", "doc_id")


def wide_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents for word work, spread by key over the cores, and over more tasks the more text there is."""
    read = spark.read.parquet(f"{folder}/documents.parquet")
    return S.texts_from(read, "text", "doc_id", S.text_tasks(read, "text"))


def polarity_labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet").select(
        F.col("doc_id").alias("row_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("positive"))


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return induce_lexicon(wide_documents(spark, folder), polarity_labels(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return lexicon_scores(wide_documents(spark, folder), lexicon(spark, folder))


def partly_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a score where a label exists; the others are pending."""
    given = polarity_labels(spark, folder).select("row_id", F.when(F.col("positive"), 8).otherwise(2).alias("score"))
    return documents(spark, folder).join(given, "row_id", "left")


def partly_classified(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their source as class where a label exists."""
    return partly_scored(spark, folder).withColumn("class", F.when(F.col("score").isNotNull(), F.col("source")))


def source_number(source: Column) -> Column:
    return F.regexp_extract(source, "[0-9]+", 0).cast("int")


def tokenised(spark: SparkSession, folder: str) -> DataFrame:
    return with_tokens(wide_documents(spark, folder), stop_words=S.default_stop_words())


def weighted(spark: SparkSession, folder: str) -> tuple[DataFrame, vectors.Vocabulary]:
    """Documents with unit TF-IDF vectors; words are read twice, never exchanged."""
    tokens = tokenised(spark, folder)
    vocabulary = vectors.fit_vocabulary(tokens)
    return vectors.tfidf_vectors(tokens, vocabulary), vocabulary


# ---- answers derived from the tables ---------------------------------------------

def score_answers(spark: SparkSession, folder: str) -> DataFrame:
    """(bucket, batch_no, n, row_ids, response): score lists, some of them faulty."""
    n = F.col("n_chars")
    item = (
        F.when(F.col("row_id") % 97 == 0, "11").when(F.col("row_id") % 89 == 0, "7.5")
        .when(F.col("row_id") % 83 == 0, "3<sep>4").otherwise((n % 11).cast("string"))
    )
    return _batched_answers(documents(spark, folder).select("row_id", item.alias("item")))


def label_answers(spark: SparkSession, folder: str) -> DataFrame:
    item = (
        F.when(F.col("row_id") % 97 == 0, "elsewhere").when(F.col("row_id") % 83 == 0, "src1<sep>src2")
        .otherwise(F.col("source"))
    )
    return _batched_answers(documents(spark, folder).select("row_id", item.alias("item")))


def _batched_answers(items: DataFrame) -> DataFrame:
    batches = batching.assign_batches(items).groupBy("bucket", "batch_no").agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.array_sort(F.collect_list("row_id")).alias("row_ids"),
        F.expr("listagg(item, '<sep>') WITHIN GROUP (ORDER BY row_id)").alias("list"),
    )
    framed = (
        F.when(F.col("batch_no") % 11 == 10, "")
        .when(F.col("batch_no") % 5 == 0, F.concat(F.lit(" <sep>"), "list", F.lit("<sep>\n")))
        .otherwise(F.col("list"))
    )
    return batches.select("bucket", "batch_no", "n", "row_ids", framed.alias("response"))


def group_answers(spark: SparkSession, folder: str) -> DataFrame:
    """(source, response): issue and reason lists per source, some of them faulty."""
    facts = documents(spark, folder).groupBy("source").agg(
        F.count(F.lit(1)).cast("string").alias("c"), F.max("n_chars").cast("string").alias("m"),
        F.min("lang").alias("a"), F.max("lang").alias("z"))
    issues = F.concat(F.lit(f"{A.ISSUES_HEADING}{A.HEADING_COLON}1."), "a", F.lit("<sep0>2."), "z")
    reasons = F.concat(F.lit(f"{A.REASONS_HEADING}{A.HEADING_COLON}1."), "c", F.lit("<sep0>2."), "m")
    number = source_number(F.col("source"))
    response = (
        F.when(number % 7 == 3, issues)
        .when(number % 7 == 4, F.concat(issues, F.lit("<sep0>"), reasons))
        .when(number % 7 == 5, F.concat(issues, F.lit("<sep0>3.x<sep1>"), reasons))
        .when(number % 7 == 6, F.concat(issues, F.lit("<sep1>"), reasons, F.lit("<sep1>\n")))
        .otherwise(F.concat(issues, F.lit("<sep1>\n"), reasons))
    )
    return facts.select("source", response.alias("response"))


def label_lists(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, answer): a numbered label list per document."""
    kind = F.col("row_id") % 5
    answer = (
        F.when(kind == 0, F.concat(F.lit("Labels：1."), "source", F.lit("<sep>2."), "lang", F.lit("é<sep>")))
        .when(kind == 1, F.concat(F.lit("1."), "lang", F.lit("<sep>2.价格 x<sep>10."), "source"))
        .when(kind == 2, F.concat(F.lit("1."), "lang", F.lit("问题<sep>2."), "source"))
        .when(kind == 3, F.concat(F.lit("none for "), "lang"))
        .otherwise(F.concat(F.lit("<sep>7、"), "lang", F.lit("_x"))))
    return documents(spark, folder).select("row_id", answer.alias("answer"))


def review_answers(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("row_id") % 7
    answer = (
        F.when(kind == 0, "y").when(kind == 1, F.concat(F.lit("n<sep>merge "), "lang"))
        .when(kind == 2, "n").when(kind == 3, F.concat(F.lit("1."), "source", F.lit("<sep>2."), "lang"))
        .when(kind == 4, "no idea").when(kind == 5, F.concat(F.lit("1."), "lang", F.lit("<sep>two")))
        .otherwise(F.concat(F.lit("yes "), "source")))
    return documents(spark, folder).select(F.col("row_id").alias("review_id"), answer.alias("answer"))


# ---- sources and sinks --------------------------------------------------------------

def read_texts_csv(spark, folder):
    path = scratch_path(spark, "texts_csv")
    (documents(spark, folder).select("row_id", "content").write
     .option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).csv(path))
    return S.read_texts_csv(spark, path, "row_id BIGINT, content STRING", multi_line=True)


def read_stop_words(spark, folder):
    """Words in a fifth of all texts, written one per line and read as a stop list."""
    texts = wide_documents(spark, folder)
    tokens = with_tokens(texts).select("row_id", "tokens")
    frequent = vectors.term_counts(tokens).filter(F.col("df") * 5 >= texts.count())
    path = scratch_path(spark, "stop_words")
    spellings = F.explode(F.array(F.col("term"), F.upper("term"), F.concat(F.lit("  "), "term"), F.lit("12")))
    frequent.select(spellings.alias("value")).write.text(path)
    return S.read_stop_words(spark, path)


def preview_texts(spark, folder):
    return S.preview(documents(spark, folder).select("row_id", "content"), 5)


def preview_conclusion(spark, folder):
    return S.preview_conclusion(conclusion_lines(spark, folder), 3)


def analysis_outputs(spark, folder):
    """The four results are written, read back and counted."""
    path = scratch_path(spark, "results")
    S.save_results(analyze(wide_documents(spark, folder), OfflineBackend(lexicon(spark, folder))), path)
    counted = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("output"), "n_rows")
        for name, table in S.load_results(spark, path).items()
    ]
    return reduce(DataFrame.unionByName, counted)


# ---- projections and filters ------------------------------------------------------------

def pending_column(spark, folder):
    return documents(spark, folder).select(
        "row_id", C.pending_value("int").alias("score"), C.pending_value("string").alias("class"))


def score_as_double(spark, folder):
    answers = score_answers(spark, folder)
    items = answers.select("batch_no", "bucket", F.posexplode(A.split_items(F.col("response"))).alias("pos", "item"))
    return items.select("bucket", "batch_no", "pos", "item", C.as_double(F.col("item")).alias("score"))


def sentiment_bands(spark, folder):
    return scored(spark, folder).select("row_id", "score", C.sentiment_band(F.col("score")).alias("band"))


def negative_texts(spark, folder):
    return scored(spark, folder).filter(C.is_negative(F.col("score"))).select("row_id", "content", "score")


def pending_rows(spark, folder):
    return partly_scored(spark, folder).filter(C.is_pending(F.col("score"))).select("row_id", "lang", "source")


def negative_positions(spark, folder):
    return partly_scored(spark, folder).filter(C.is_negative(F.col("score"))).select("row_id", "n_chars", "score")


def annotated_columns(spark, folder):
    return partly_classified(spark, folder).select("content", "score", "class")


def percent_display(spark, folder):
    shares = rollup.group_shares(documents(spark, folder), "lang")
    return shares.select("lang", C.percent_value(F.col("percentage")).alias("pct"),
                         C.percent_text(F.col("percentage")).alias("shown"))


# ---- joins -------------------------------------------------------------------------------

def write_back_items(spark, folder):
    checked = protocol.checked_items(score_answers(spark, folder), A.score_list_status)
    return protocol.write_back(checked).select("row_id", F.col("value").cast("int").alias("score"))


def write_back_groups(spark, folder):
    groups = documents(spark, folder).groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(
        "source", "n", F.lit(None).cast("string").alias("issues"), F.lit(None).cast("string").alias("reasons"))
    valid = group_answers(spark, folder).filter(A.issue_list_status(F.col("response")) == A.OK).select(
        "source", A.issues_of(F.col("response")).alias("issues"), A.paired_reasons_of(F.col("response")).alias("reasons"))
    return protocol.fill_groups(groups, valid, "source", ["issues", "reasons"])


def count_with_mean(spark, folder):
    return partly_classified(spark, folder).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(C.as_double(F.col("score"))), 6).alias("mean_score"))


def all_clusters(spark, folder):
    texts = documents(spark, folder).select(source_number(F.col("source")).alias("cluster"))
    top = texts.agg(F.max("cluster")).first()[0]
    shares = rollup.group_shares(texts, "cluster", None, "comment_cnt", "comment_pct")
    return (
        spark.range(top + 1 + EXTRA_CLUSTERS).select(F.col("id").cast("int").alias("cluster"))
        .join(shares, "cluster", "left")
        .select("cluster", F.coalesce("comment_cnt", F.lit(0).cast("bigint")).alias("comment_cnt"),
                F.round(F.coalesce("comment_pct", F.lit(0.0)), 6).alias("comment_pct")))


def stop_word_exclusion(spark, folder):
    stop = spark.createDataFrame([(w,) for w in S.default_stop_words()], "term string")
    spelled = with_tokens(wide_documents(spark, folder)).select("row_id", "tokens")
    return vectors.term_counts(spelled).join(F.broadcast(stop), "term", "left_anti").select("term", "cf")


def label_membership(spark, folder):
    allowed = cut(documents(spark, folder).select("source").distinct())
    items = label_answers(spark, folder).select(
        "bucket", "batch_no", F.explode(A.split_items(F.col("response"))).alias("source"))
    misses = join_sized(items, allowed, "source", "left_anti").groupBy("bucket", "batch_no").agg(F.count(F.lit(1)).alias("misses"))
    return label_answers(spark, folder).select("bucket", "batch_no").join(misses, ["bucket", "batch_no"], "left").select(
        "bucket", "batch_no", F.coalesce("misses", F.lit(0).cast("bigint")).alias("misses"))


def texts_per_group(spark, folder):
    return documents(spark, folder).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("chars"), F.min("row_id").alias("first_id"))


# ---- aggregations -----------------------------------------------------------------------

def class_counts(spark, folder):
    return rollup.group_shares(partly_classified(spark, folder), "class").select("class", "count")


def class_shares(spark, folder):
    return rollup.group_shares(partly_classified(spark, folder), "class").select(
        "class", F.round("percentage", 6).alias("percentage"))


def class_mean_score(spark, folder):
    return rollup.group_shares(partly_classified(spark, folder), "class", "score").select(
        "class", F.round("score", 6).alias("score"))


def cluster_shares(spark, folder):
    texts = partly_scored(spark, folder).withColumn("cluster", source_number(F.col("source")))
    return rollup.group_shares(texts, "cluster", "score", "comment_cnt", "comment_pct").select(
        "cluster", "comment_cnt", F.round("comment_pct", 6).alias("comment_pct"), F.round("score", 6).alias("score"))


def joined_batch_texts(spark, folder):
    keyed = batching.assign_batches(documents(spark, folder).select("row_id", "content"))
    clean = keyed.withColumn("content", A.without_delimiters(F.col("content")))
    return batching.joined_texts(clean, ["bucket", "batch_no"], "content", "row_id", A.ITEM_SEP, "body")


def pending_counts(spark, folder):
    return rollup.pending_counts(partly_scored(spark, folder), "score")


def term_counts(spark, folder):
    return vectors.term_counts(tokenised(spark, folder))


def halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter("row_id % 2 = 0"), rows.filter("row_id % 2 <> 0")


def state_table(spark: SparkSession, parts) -> state.StateTable:
    """The states of two batches, the first of which is run twice, folded after the second."""
    kept = state.StateTable(spark, scratch_path(spark, "state"))
    first, second = parts
    for number, part in ((0, first), (0, first), (1, second)):
        kept.add(part, number)
    kept.fold()
    return kept


def kept_class_summary(spark, folder):
    """Counts, shares and means from states of two halves of the rows."""
    parts = [state.group_state(half, "class", "score") for half in halves(partly_classified(spark, folder))]
    return state.shares(state_table(spark, parts).read(), "class").select(
        "class", "count", F.round("percentage", 6).alias("percentage"), F.round("score", 6).alias("score"))


def kept_term_counts(spark, folder):
    parts = [state.term_state(half) for half in halves(tokenised(spark, folder))]
    return state_table(spark, parts).read()


def single_cluster_error(spark, folder):
    texts, _ = weighted(spark, folder)
    sse = clusters.single_cluster_sse(texts.select("features"))
    return texts.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(round(sse, 4)).alias("sse"))


def distinct_labels(spark, folder):
    return documents(spark, folder).select(F.concat_ws("_", "lang", "source").alias("label")).distinct()


# ---- picks per group ------------------------------------------------------------------------

def first_texts_per_group(spark, folder):
    texts = documents(spark, folder)
    return clusters.sample_cases(texts, "source", 5)


def sampled_texts_per_group(spark, folder):
    return causes.sampled_texts(documents(spark, folder), "lang", causes.CLUSTER_SAMPLE).select(
        "lang", "rn", "row_id", "content")


def top_terms_per_group(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    top = picks.top_terms(clusters.group_means(texts, vocabulary, "lang"), "lang", 10)
    return top.select("lang", "rn", "term", F.round("weight", 6).alias("weight"))


def batch_numbers(spark, folder):
    return batching.assign_batches(documents(spark, folder).select("row_id"))


# ---- sorts and top-k -----------------------------------------------------------------------

def vocabulary_cap(spark, folder):
    return vectors.top_vocabulary(tokenised(spark, folder))


def length_curve(spark, folder) -> DataFrame:
    """Error of text lengths cut into k equal ranges, k = 1..20: a curve with an elbow."""
    sizes = documents(spark, folder).select(F.length("content").cast("bigint").alias("x"))
    longest = sizes.agg(F.max("x")).first()[0]
    cells = (
        sizes.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
        .select("x", "c", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("k"))
        .groupBy("k", F.floor(F.col("x") * F.col("k") / F.lit(longest + 1.0)).alias("cell"))
        .agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("x")).alias("s"),
             F.sum(F.col("c") * F.col("x") * F.col("x")).alias("q"))
    )
    error = F.sum(F.col("q") - F.col("s") * F.col("s").cast("double") / F.col("n"))
    return cells.groupBy("k").agg(F.round(error / 1e6, 4).alias("sse"))


def elbow_pick(spark, folder):
    return clusters.elbow_curve(length_curve(spark, folder)).filter("is_elbow").select("k", "sse")


def class_order(spark, folder):
    summary = rollup.group_shares(partly_classified(spark, folder), "class")
    return numbered(summary.select("class", "count"), "class", "place").orderBy("class")


def conclusion_rank(spark, folder):
    return rollup.ranked_by_share(rollup.group_shares(partly_classified(spark, folder), "class")).select(
        "rank", "class", "count")


# ---- set operations ------------------------------------------------------------------------

def labels_with_fallback(spark, folder):
    names = label_lists(spark, folder).select(F.explode(A.numbered_labels(F.col("answer"))).alias("label"))
    return labels.with_fallback(numbered(names.distinct(), "label", "label_id").select("label_id", "label"))


def merged_results(spark, folder):
    fresh = scored(spark, folder).select("row_id", "score")
    return rollup.merge_results(partly_scored(spark, folder).select("row_id", "score"), fresh, "score")


# ---- scalar functions -----------------------------------------------------------------------

def stripped_answers(spark, folder):
    return score_answers(spark, folder).select("bucket", "batch_no", A.strip_outer(F.col("response")).alias("bare"))


def split_answers(spark, folder):
    return score_answers(spark, folder).select(
        "bucket", "batch_no", F.posexplode(A.split_items(F.col("response"))).alias("pos", "item"))


def answer_counts(spark, folder):
    found = A.item_count(F.col("response"))
    return score_answers(spark, folder).select(
        "bucket", "batch_no", "n", found.alias("items"), (found == F.col("n")).alias("complete"))


def score_format(spark, folder):
    return score_answers(spark, folder).select(
        "bucket", "batch_no", A.strip_outer(F.col("response")).rlike(A.SCORE_LIST_PATTERN).alias("well_formed"))


def required_headings(spark, folder):
    r = F.col("response")
    return group_answers(spark, folder).select(
        "source", r.contains(A.ISSUES_HEADING).alias("has_issues"), r.contains(A.REASONS_HEADING).alias("has_reasons"))


def section_counts(spark, folder):
    lists = A.split_items(F.col("response"), A.PAIR_LIST_SEP)
    return group_answers(spark, folder).select(
        "source", F.size(lists).alias("lists"),
        F.size(F.split(F.get(lists, F.lit(0)), A.PAIR_ITEM_SEP, -1)).alias("first_items"),
        F.coalesce(F.size(F.split(F.get(lists, F.lit(1)), A.PAIR_ITEM_SEP, -1)), F.lit(-1)).alias("second_items"))


def extracted_sections(spark, folder):
    valid = group_answers(spark, folder).filter(A.issue_list_status(F.col("response")) == A.OK)
    return valid.select("source", A.issues_of(F.col("response")).alias("issues"),
                        A.paired_reasons_of(F.col("response")).alias("reasons"),
                        A.reasons_of(F.col("response")).alias("tail"))


def numbered_labels(spark, folder):
    return label_lists(spark, folder).select(
        "row_id", F.array_join(A.numbered_labels(F.col("answer")), "|").alias("labels"))


def numbered_list_check(spark, folder):
    return label_lists(spark, folder).select("row_id", A.is_numbered_list(F.col("answer")).alias("is_list"))


def answer_routing(spark, folder):
    return review_answers(spark, folder).select("review_id", A.review_decision(F.col("answer")).alias("decision"))


def templated_lines(spark, folder):
    groups = documents(spark, folder).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("lang").alias("z"))
    return groups.select("source", F.format_string("Source %s holds %d texts, last language %s.", "source", "n", "z").alias("line"))


def long_words(spark, folder):
    raw = F.explode(F.regexp_extract_all(F.lower("content"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))).alias("term")
    return documents(spark, folder).select(raw).filter(F.length("term") > 1).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def words_per_text(spark, folder):
    return term_rows(with_tokens(wide_documents(spark, folder))).groupBy("row_id", "term").agg(F.count(F.lit(1)).alias("n"))


def chord_distance(spark, folder):
    curve = clusters.elbow_curve(length_curve(spark, folder))
    return curve.select("k", F.round("fitted", 4).alias("fitted"), F.round("residual", 4).alias("residual"))


# ---- text and clustering ----------------------------------------------------------------------

def clean_tokens(spark, folder):
    return term_rows(tokenised(spark, folder)).groupBy("row_id", "term").agg(F.count(F.lit(1)).alias("n"))


def tfidf_weights(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    return vectors.long_weights(texts, vocabulary).select("row_id", "term", F.round("weight", 6).alias("weight"))


def cluster_error_sweep(spark, folder):
    # texts are read and cut into words once, as in clusters.cluster_texts
    tokens = to_table(tokenised(spark, folder).select("row_id", "tokens"), "tokens")
    placed = clusters.lay_out(vectors.tfidf_vectors(tokens, vectors.fit_vocabulary(tokens)).select("row_id", "features"))
    return clusters.sweep(placed).table(spark)


def cluster_sweep_facts(spark, folder):
    """What SQL can state of the sweep: the tried k, the error of k = 1, one elbow."""
    curve = cluster_error_sweep(spark, folder)
    return curve.agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first_k"), F.max("k").alias("last_k"),
                     F.round(F.max(F.when(F.col("k") == 1, F.col("sse"))), 4).alias("single_sse"),
                     F.count_if("is_elbow").alias("elbows"))


def elbow_curve(spark, folder):
    return clusters.elbow_curve(length_curve(spark, folder)).select(
        "k", "sse", F.round("fitted", 4).alias("fitted"), F.round("residual", 4).alias("residual"), "is_elbow")


def nearest_centroid(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    texts = to_table(texts.select("row_id", "source", "features"), "weighted_texts")
    means = cut(clusters.group_means(texts, vocabulary, "source"))
    if means.count() <= BROADCAST_ROWS:
        nearest = clusters.nearest_in_row(texts.drop("source"), vocabulary, means, "source").filter("source IS NOT NULL")
    else:
        nearest = clusters.nearest_centroid(vectors.long_weights(texts, vocabulary), means, "source")
    return nearest.select("row_id", "source", "similarity")


def group_keywords(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    return clusters.keyword_lists(clusters.group_means(texts, vocabulary, "source"), "source")


def _given_clusters(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    texts = to_table(texts.withColumn("cluster", source_number(F.col("source"))), "clustered_texts")
    means = to_table(clusters.group_means(texts, vocabulary, "cluster"), "centroids")
    top = texts.agg(F.max("cluster")).first()[0]
    return texts, vocabulary, means, top + 1


def group_summary(spark, folder):
    texts, _, means, k = _given_clusters(spark, folder)
    labelled = texts.join(partly_scored(spark, folder).select("row_id", "score"), "row_id")
    summary = clusters.cluster_summary(labelled, means, k + EXTRA_CLUSTERS, score_col="score")
    return summary.select("cluster", "keywords", "sample_cases", "comment_cnt",
                          F.round("comment_pct", 6).alias("comment_pct"), F.round("score", 6).alias("score"))


def clustered_texts(spark, folder):
    found = clusters.cluster_texts(wide_documents(spark, folder), stop_words=S.default_stop_words())
    return found.summary.select("cluster", "keywords", "comment_cnt", "comment_pct")


def clustered_text_facts(spark, folder):
    """What SQL can state of a clustering: clusters are 0..k-1, every text is in one."""
    return clustered_texts(spark, folder).agg(
        F.min("cluster").alias("first"), (F.max("cluster") + 1 == F.count(F.lit(1))).alias("dense"),
        F.sum("comment_cnt").alias("texts"), F.round(F.sum("comment_pct"), 6).alias("share"))


def class_summary(spark, folder):
    return rollup.class_summary(partly_classified(spark, folder), "class", "score").select(
        "class", "count", F.round("percentage", 6).alias("percentage"), F.round("score", 6).alias("score"), "reasons")


# ---- model-backed steps ---------------------------------------------------------------------------

def induced_lexicon(spark, folder):
    return lexicon(spark, folder).select("term", F.col("polarity").cast("int").alias("polarity"))


def score_texts(spark, folder):
    return scored(spark, folder).select("row_id", "score")


def negative_shares(spark, folder):
    negatives = scored(spark, folder).filter(C.is_negative(F.col("score")))
    return rollup.group_shares(negatives, "source", "score").select(
        "source", "count", F.round("percentage", 6).alias("percentage"), F.round("score", 6).alias("score"))


def note_remover():
    """Function that drops the corrective notes a repeated prompt starts with."""
    notes = [note + "\n\n" for note in protocol.NOTES.values()]

    def bare(prompt):
        while any(prompt.startswith(note) for note in notes):
            prompt = prompt.split("\n\n", 1)[1]
        return prompt

    return bare


def length_scorer():
    """A stand-in model: the score is the text length modulo 11.

    Texts of a length divisible by 13 never get a valid score; some large batches
    first lose an item.
    """
    bare = note_remover()

    def reply(instruction, prompts):
        out = []
        for prompt in map(bare, prompts):
            texts = prompt.split("<sep>")
            items = ["n/a" if len(t) % 13 == 0 else str(len(t) % 11) for t in texts]
            if len(items) > 20 and len(prompt) % 3 == 0:
                items.pop()
            out.append("<sep>".join(items))
        return out

    return reply


def length_labeller(names):
    bare = note_remover()

    def reply(instruction, prompts):
        out = []
        for prompt in map(bare, prompts):
            texts = prompt.split("<sep>")
            out.append("<sep>".join("elsewhere" if len(t) % 17 == 0 else names[len(t) % len(names)] for t in texts))
        return out

    return reply


def length_describer():
    """A stand-in model for groups; it leaves out a heading until a note asks for it."""
    note = protocol.NOTES[A.OMITTED]
    issues, reasons = A.ISSUES_HEADING + A.HEADING_COLON, A.REASONS_HEADING + A.HEADING_COLON

    def reply(instruction, prompts):
        out = []
        for prompt in prompts:
            noted = prompt.startswith(note + "\n\n")
            body = prompt[len(note) + 2:] if noted else prompt
            if not noted and len(body) % 2:
                out.append("no heading")
            else:
                out.append(f"{issues}1.chars {len(body)}<sep0>2.lines<sep1>{reasons}1.length<sep0>2.{body.count(chr(10)) + 1}")
        return out

    return reply


def scored_by_function(spark, folder):
    answered = CallableBackend(length_scorer()).score(
        documents(spark, folder).select("row_id", "content"), "content", "score", 30)
    return answered.rows.select("row_id", "score")


def quarantined_rows(spark, folder):
    answered = CallableBackend(length_scorer()).score(
        documents(spark, folder).select("row_id", "content"), "content", "score", 30)
    return answered.quarantine.select("row_id", "status", "response")


def _stopping(limit: int):
    """``length_scorer`` that has no line for prompts of few texts, as if it broke down after the rounds of many."""
    reply, bare = length_scorer(), note_remover()

    def stopping(instruction, prompts):
        if any(bare(p) != p and bare(p).count("<sep>") < limit for p in prompts):
            raise ConnectionError("no line")
        return reply(instruction, prompts)

    return stopping


def _crashed_and_resumed(spark, folder):
    """(rows, ledger) of a run that broke down in its later rounds and was taken up again under its name."""
    texts = documents(spark, folder).select("row_id", "content")
    name = f"query-{uuid.uuid4().hex}"
    try:
        CallableBackend(_stopping(7), run=name).score(texts, "content", "score", 30)
    except RuntimeError:  # what the run is about
        pass
    backend = CallableBackend(length_scorer(), run=name)
    return backend.score(texts, "content", "score", 30).rows, backend.ledger(spark)


def resumed_run(spark, folder):
    """Scores of a run that was cut off and resumed; ``asked_again`` counts its prompts with more than one stored answer."""
    rows, ledger = _crashed_and_resumed(spark, folder)
    again = ledger.answers().groupBy("key").count().agg(F.count_if(F.col("count") > 1)).scalar()
    return rows.select("row_id", "score", again.alias("asked_again"))


def run_rounds(spark, folder):
    """What the manifest of a resumed run says of its first round, which was complete before the run broke down."""
    _, ledger = _crashed_and_resumed(spark, folder)
    return ledger.manifest().where("round = 0").select("step", "round", "prompts", "passes")


def equal_texts(spark, folder):
    """Every text with the smallest key that holds it, which is asked for all its copies, and their number."""
    rows = documents(spark, folder).where(F.col("content").rlike(r"\S")).select(
        "row_id", "content", F.unhex(F.md5("content")).alias("__text"))
    texts = protocol.distinct_texts(rows, "content", "row_id").select(
        "__text", "__copies", F.col("row_id").alias("asked_row"), F.col("__copies").alias("copies"))
    return protocol.spread(rows, to_table(texts, "distinct_texts"), rows.count()).select("row_id", "asked_row", "copies")


def described_by_function(spark, folder):
    texts = documents(spark, folder)
    bodies = causes.sample_bodies(texts, "lang", causes.CLUSTER_SAMPLE)
    task = protocol.GroupTask(A.issue_list_status, {"issues": A.issues_of, "reasons": A.paired_reasons_of})
    found, _ = protocol.annotate_groups(bodies, "lang", task, asker(length_describer(), "describe"))
    return found


def group_prompts(spark, folder):
    return causes.sample_bodies(documents(spark, folder), "lang", causes.CLUSTER_SAMPLE)


def group_issues(spark, folder):
    texts, vocabulary, means, k = _given_clusters(spark, folder)
    empty = spark.range(k).select(F.col("id").cast("int").alias("cluster"), C.pending_value("string").alias("issues"),
                                  C.pending_value("string").alias("reasons"))
    given = clusters.Clustering(texts, vocabulary, means, None, k, empty)
    return OfflineBackend(None).describe(given, "content").rows


def label_proposals(spark, folder):
    """Labels of all numbered answers, each once, with the fallback appended."""
    found = label_lists(spark, folder).select("row_id", F.posexplode(A.numbered_labels(F.col("answer"))).alias("pos", "label"))
    fallback = label_lists(spark, folder).select("row_id", F.lit(-1).alias("pos"), F.lit(A.FALLBACK_LABEL).alias("label"))
    return found.unionByName(fallback)


def term_overlap(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    top = cut(picks.top_terms(clusters.group_means(texts, vocabulary, "source"), "source", 10))
    return labels.term_overlap(top, "source").select(
        "left_group", "right_group", "shared", F.round("jaccard", 6).alias("jaccard"))


def merged_groups(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    top = cut(picks.top_terms(clusters.group_means(texts, vocabulary, "source"), "source", 10))
    merged = labels.merge_groups(top, "source", 0.5)
    return labels.two_term_labels(top, merged, "source")


def label_reviews(spark, folder):
    routed = labels.review_routes(review_answers(spark, folder))
    return routed.select("review_id", "decision", "hint", F.array_join("labels", "|").alias("labels"))


def hinted_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Redo reviews whose hints name sources and languages, with and without wishes that can be read."""
    kind = F.col("row_id") % 4
    hint = (
        F.when(kind == 0, F.concat(F.lit("please Merge "), "source", F.lit(" and "), "lang"))
        .when(kind == 1, F.concat(F.lit("split "), "lang", F.lit(" from "), "source", F.lit("; merge x_1 with "), "source"))
        .when(kind == 2, F.concat(F.lit("merge "), "lang")).otherwise(F.concat(F.lit("submerge "), "lang", F.lit(" and "), "source")))
    return documents(spark, folder).select(F.col("row_id").alias("review_id"), F.concat(F.lit("n<sep>"), hint).alias("answer"))


def hint_wishes(spark, folder):
    """What the hints of redo reviews ask for."""
    routed = labels.review_routes(hinted_reviews(spark, folder))
    return hints.wished(routed.select("review_id", "hint"))


def wished_groups(spark, folder):
    """Sources merged by overlap of their terms and by a hint that names the best terms of the first two sources."""
    texts, vocabulary = weighted(spark, folder)
    top = cut(picks.top_terms(clusters.group_means(texts, vocabulary, "source"), "source", 10))
    best = top.filter("rn = 1").orderBy("source").limit(2)
    hint = best.agg(F.concat(F.lit("merge "), F.min_by("term", "source"), F.lit(" and "), F.max_by("term", "source")).alias("hint"))
    ends = cut(hints.sides(hints.wished(hint), top, top.limit(0).select("source", F.lit("").alias("label")), "source"))
    return hints.merge_as_wished(top, "source", ends, 0.5)[0]


def classified_by_cosine(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    texts = to_table(texts, "weighted_texts")
    means = to_table(clusters.group_means(texts, vocabulary, "lang"), "prototypes").withColumnRenamed("lang", "label")
    names = [r.lang for r in texts.select("lang").distinct().orderBy("lang").collect()]
    label_set = LabelSet(labels.with_fallback(labels.label_frame(spark, names)), [*names, A.FALLBACK_LABEL], means)
    given = clusters.Clustering(texts, vocabulary, means, None, 0, None)
    backend = OfflineBackend(None, min_similarity=0.3)
    return backend.classify(given, texts, label_set, "content", "class", 30).rows.select("row_id", "class")


def classified_by_function(spark, folder):
    names = [r.source for r in documents(spark, folder).select("source").distinct().orderBy("source").collect()]
    label_set = LabelSet(labels.label_frame(spark, names), names)
    answered = CallableBackend(length_labeller(names)).classify(
        None, documents(spark, folder).select("row_id", "content"), label_set, "content", "class", 30)
    return answered.rows.select("row_id", "class")


def typical_causes(spark, folder):
    texts, vocabulary = weighted(spark, folder)
    texts = to_table(texts, "weighted_texts")
    means = to_table(clusters.group_means(texts, vocabulary, "source"), "centroids")
    return causes.typical_causes(texts, means, "source")


def explained_by_function(spark, folder):
    heading = A.REASONS_HEADING + A.HEADING_COLON

    def reply(instruction, prompts):
        return [f"So: {heading}1.{len(p)} characters<sep>2.of text " for p in prompts]

    texts = documents(spark, folder).withColumnRenamed("lang", "class")
    summary = rollup.class_summary(texts, "class")
    rows = CallableBackend(reply).explain(None, texts, summary, "content", "class").rows
    return rows.select("class", "count", F.round("percentage", 6).alias("percentage"), "reasons")


def conclusion_lines(spark, folder):
    summary = rollup.class_summary(partly_classified(spark, folder), "class", "score")
    facts = documents(spark, folder).groupBy(F.col("source").alias("class")).agg(
        F.concat_ws(",", F.min("lang"), F.max("n_chars").cast("string")).alias("reasons"))
    return conclusion.conclusion_lines(protocol.fill_groups(summary, facts, "class", ["reasons"]))


def conclusion_text(spark, folder):
    return conclusion.conclusion_text(conclusion_lines(spark, folder))


def answer_status(spark, folder):
    scores = score_answers(spark, folder).select(
        F.lit("score").alias("kind"), F.concat_ws("/", F.col("bucket").cast("string"), F.col("batch_no").cast("string")).alias("key"),
        A.score_list_status(F.col("response"), F.col("n")).alias("status"))
    allowed = documents(spark, folder).select(F.col("source").alias("item")).distinct()
    label = protocol.label_statuses(label_answers(spark, folder), ["bucket", "batch_no"], allowed).select(
        F.lit("label").alias("kind"), F.concat_ws("/", F.col("bucket").cast("string"), F.col("batch_no").cast("string")).alias("key"),
        "status")
    groups = group_answers(spark, folder)
    issue = groups.select(F.lit("issue").alias("kind"), F.col("source").alias("key"),
                          A.issue_list_status(F.col("response")).alias("status"))
    reason = groups.select(F.lit("reason").alias("kind"), F.col("source").alias("key"),
                           A.reason_list_status(F.col("response")).alias("status"))
    return scores.unionByName(label).unionByName(issue).unionByName(reason)


def resumed_scores(spark, folder):
    """Stored scores are kept; only rows without one are scored."""
    stored = partly_scored(spark, folder).filter(F.col("score").isNotNull()).select("row_id", "score")
    todo = rollup.resume(wide_documents(spark, folder), stored)
    fresh = lexicon_scores(todo, lexicon(spark, folder)).select("row_id", "score")
    return stored.withColumn("resumed", F.lit(True)).unionByName(fresh.withColumn("resumed", F.lit(False)))


def analyze_feedback(spark, folder):
    """The whole analysis over all documents; one row per problem label."""
    results = analyze(wide_documents(spark, folder), OfflineBackend(lexicon(spark, folder)))
    return results.class_summary.join(results.conclusion.select("rank", "class", "pct"), "class").select(
        "rank", "class", "count", "percentage", "pct", "score", "reasons")


def analysis_facts(spark, folder):
    """What SQL can state of an analysis: every negative text is in one class, shares add up, ranks are dense."""
    return analyze_feedback(spark, folder).agg(
        F.sum("count").alias("texts"), F.round(F.sum("percentage"), 6).alias("share"), F.min("rank").alias("first"),
        (F.max("rank") == F.count(F.lit(1))).alias("dense"))


def stored_outputs(spark, folder):
    """The stored results that have a row per negative text."""
    return analysis_outputs(spark, folder).filter(F.col("output") == "classified")


QUERIES = {
    f.__name__: f for f in (
        read_texts_csv, read_stop_words, preview_texts, preview_conclusion, analysis_outputs,
        pending_column, score_as_double, sentiment_bands, negative_texts, pending_rows, negative_positions,
        annotated_columns, percent_display,
        write_back_items, write_back_groups, count_with_mean, all_clusters, stop_word_exclusion, label_membership,
        texts_per_group,
        class_counts, class_shares, class_mean_score, cluster_shares, joined_batch_texts, pending_counts, term_counts,
        kept_class_summary, kept_term_counts,
        single_cluster_error, distinct_labels,
        first_texts_per_group, sampled_texts_per_group, top_terms_per_group, batch_numbers,
        vocabulary_cap, elbow_pick, class_order, conclusion_rank,
        labels_with_fallback, merged_results,
        stripped_answers, split_answers, answer_counts, score_format, required_headings, section_counts,
        extracted_sections, numbered_labels, numbered_list_check, answer_routing, templated_lines, long_words,
        words_per_text, chord_distance,
        clean_tokens, tfidf_weights, cluster_error_sweep, cluster_sweep_facts, elbow_curve, nearest_centroid, group_keywords,
        group_summary, clustered_texts, clustered_text_facts, class_summary,
        induced_lexicon, score_texts, negative_shares, scored_by_function, quarantined_rows, resumed_run,
        run_rounds, equal_texts, described_by_function,
        group_prompts, group_issues, label_proposals, term_overlap, merged_groups, label_reviews,
        hint_wishes, wished_groups,
        classified_by_cosine, classified_by_function, typical_causes, explained_by_function, conclusion_lines,
        conclusion_text, answer_status, resumed_scores, analyze_feedback, analysis_facts, stored_outputs,
    )
}
