"""Independence of layout, skew, repeated fits, retry rounds and the whole analysis."""

import pyarrow as pa
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from feedback_loom import CallableBackend, FeedbackAnalysis, OfflineBackend, analyze, catalog, texts_from
from feedback_loom.backends import calling
from feedback_loom.backends.base import LabelSet
from feedback_loom.backends.lexicon import lexicon_scores
from feedback_loom.functions import answers as A
from feedback_loom.operators import batching, clusters, labels, picks, protocol, rollup, vectors
from feedback_loom.operators.numbering import numbered
from feedback_loom.plans.analyze import choose_labels, score_and_store
from feedback_loom.session import join_sized, to_table


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of 6,000 rows share one group; ids are multiples of 64."""
    return spark.range(6_000).select(
        (F.col("id") * 64).alias("row_id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("content"))


def test_picks_do_not_depend_on_layout_or_slices(skewed):
    order = [picks.sample_order(F.col("row_id")), F.col("row_id")]
    plain = rows(picks.rank_within(skewed.select("g", "row_id"), ["g"], order, 100), "g", "rn", "row_id")
    for layout in (skewed.coalesce(1), skewed.repartition(9)):
        assert rows(picks.sampled_ids(layout, "g", 100), "g", "rn", "row_id") == plain
    assert sum(1 for r in plain if r[0] == "hot") == 100


def test_picks_rank_slices_before_groups(skewed):
    plan = picks.sampled_ids(skewed, "g", 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "SinglePartition" not in plan


def test_batches_are_full_and_layout_free(skewed):
    got = rows(batching.assign_batches(skewed, batch_size=30), "row_id", "bucket", "batch_no", "pos")
    assert got == rows(batching.assign_batches(skewed.repartition(9), batch_size=30), "row_id", "bucket", "batch_no", "pos")
    assert len({r[1] for r in got}) == 2
    sizes = {}
    for _, bucket, batch, _ in got:
        sizes[bucket, batch] = sizes.get((bucket, batch), 0) + 1
    assert max(sizes.values()) == 30
    assert sum(1 for n in sizes.values() if n < 30) <= 2


def test_small_side_is_broadcast_and_large_side_is_not(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = skewed.limit(5).select("row_id")
        small = join_sized(skewed, few, "row_id")._jdf.queryExecution().executedPlan().toString()
        large = join_sized(skewed, skewed.select("row_id"), "row_id", max_bytes=10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


def test_lexicon_paths_agree(spark, folder):
    texts, lexicon = catalog.documents(spark, folder), catalog.lexicon(spark, folder)
    local = rows(lexicon_scores(texts, lexicon), "row_id", "score")
    joined = rows(lexicon_scores(texts, lexicon, row_local_terms=10), "row_id", "score")
    assert local == joined and len(local) == 200


def test_filter_on_scores_reads_words_once(spark, folder):
    plan = catalog.negative_texts(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 2  # plain and mixed spelling, once each


def test_fits_do_not_depend_on_layout(spark, folder):
    texts, vocabulary = catalog.weighted(spark, folder)
    found = []
    for layout in (texts.coalesce(1), texts.repartition(7)):
        placed = clusters.lay_out(layout.select("row_id", "features"))
        found.append(dict(clusters.sweep(placed, 4).curve))
    assert found[0] == pytest.approx(found[1])


def test_fits_keep_vectors_and_few_run_at_a_time(spark, monkeypatch):
    rows = [(i, Vectors.sparse(9, [i % 8, 8], [1.0, 0.1 + i % 7])) for i in range(60)]
    placed = clusters.lay_out(spark.createDataFrame(rows, ["row_id", "features"]), partitions=5)
    fitted, fit = [], clusters.KMeans.fit
    monkeypatch.setattr(clusters.KMeans, "fit", lambda self, df: fitted.append((df.storageLevel, self.getSolver())) or fit(self, df))
    found = clusters.sweep(placed, 4)
    # a frame that is persisted itself is decoded anew in each pass
    assert {(level.useMemory, solver) for level, solver in fitted} == {(False, "row")} and len(fitted) == 3
    for k, sse in found.curve[1:]:
        alone = KMeans(k=k, seed=clusters.SEED).fit(placed)
        assert sse == pytest.approx(alone.summary.trainingCost)
    assert clusters.fits_at_once(placed, 8) >= clusters.fits_at_once(placed.repartition(500), 8) == 2
    assert clusters.fits_at_once(placed, 1) == 1


def test_words_of_the_sweep_are_cut_once(spark, folder, monkeypatch):
    written, to_table = [], catalog.to_table
    monkeypatch.setattr(catalog, "to_table", lambda df, name, *more: written.append(name) or to_table(df, name, *more))
    catalog.cluster_error_sweep(spark, folder)
    assert written == ["tokens"]


def test_k_is_capped_by_distinct_texts(spark):
    df = spark.createDataFrame([(i, "bad room" if i % 2 else "slow staff") for i in range(12)], "row_id long, content string")
    found = clusters.cluster_texts(df, max_clusters=20)
    assert found.curve.count() == 2
    summary = found.summary.collect()
    assert len(summary) == found.k and sum(r.comment_cnt for r in summary) == 12
    assert all(0 not in [len(w) for w in r.keywords.split(", ")] for r in summary)


def test_text_without_vocabulary_gets_zero_vector(spark):
    df = spark.createDataFrame([(1, ["aa"]), (2, [])], "row_id long, tokens array<string>")
    vocabulary = vectors.fit_vocabulary(df)
    got = {r.row_id: r.features.toArray().tolist() for r in vectors.tfidf_vectors(df, vocabulary).collect()}
    assert got == {1: [1.0], 2: [0.0]}


# ---- retry rounds ------------------------------------------------------------------

def test_a_call_holds_few_bytes_of_its_batch(spark, monkeypatch):
    monkeypatch.setattr(calling, "CALL_BYTES", 10)
    prompts = pa.array(["aaaa", None, "bbbb", "cccccccccccccccc", "ä", None, "d"])
    assert list(calling.calls_of(prompts)) == [([0, 2], ["aaaa", "bbbb"]), ([3], ["cccccccccccccccc"]), ([4, 6], ["ä", "d"])]

    def reply(instruction, texts):
        if "cccccccccccccccc" in texts:
            raise ConnectionError("no line")
        return [f"{len(texts)} {t}" for t in texts]

    got = calling.careful_asker(reply, "").func(iter([prompts]))
    answered = next(got).to_pylist()
    assert [a["response"] for a in answered] == ["2 aaaa", None, "2 bbbb", None, "2 ä", None, "2 d"]
    assert [a["error"] for a in answered] == [None] * 3 + ["ConnectionError: no line"] + [None] * 3
    assert next(calling.asker(lambda instruction, texts: texts, "").func(iter([prompts]))).to_pylist() == prompts.to_pylist()


def test_buckets_are_spread_over_more_tasks_than_there_are(spark):
    texts = spark.range(90_000).select(F.col("id").alias("row_id"), F.lit(None).cast("string").alias("note"),
                                       F.struct("id", F.lit("x").alias("content")).alias("payload"))
    buckets = batching.bucket_count(90_000, 30)
    batches = protocol._batched_rows(texts, "row_id", "content", 30, 90_000)
    most = batches.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert buckets >= protocol.call_tasks(spark, 3_000) and most <= 4 * 102
    assert batches.rdd.getNumPartitions() == protocol.TASKS_PER_BUCKET * buckets


def scorer(bad=lambda text: False):
    bare = catalog.note_remover()

    def reply(instruction, prompts):
        return ["<sep>".join("n/a" if bad(t) else str(len(t) % 11) for t in bare(p).split("<sep>")) for p in prompts]

    return reply


def test_rounds_isolate_permanent_faults(skewed):
    backend = CallableBackend(scorer(lambda t: t.endswith("77")))
    texts = skewed.limit(300)
    answered = backend.score(texts, "content", "score", 30)
    got = {r.row_id: r.score for r in answered.rows.collect()}
    faulty = {r.row_id for r in texts.collect() if r.content.endswith("77")}
    assert len(got) == 300 and {k for k, v in got.items() if v is None} == faulty
    kept = {(r.row_id, r.status, r.response) for r in answered.quarantine.collect()}
    assert kept == {(k, "format", "n/a") for k in faulty}


def test_halving():
    assert protocol.halving_sizes(30) == [30, 15, 7, 3, 1]
    assert protocol.halving_sizes(1) == [1]


def test_only_pending_rows_are_asked(spark):
    df = spark.createDataFrame([(1, "aaa", 9), (2, "bb", None), (3, None, None), (4, " ", None), (5, "x<sep>y", None)],
                               "row_id long, content string, score int")
    answered = CallableBackend(scorer(lambda t: t == "aaa")).score(df, "content", "score", 30)
    assert rows(answered.rows.fillna(-1, ["score"]), "row_id", "score") == [(1, 9), (2, 2), (3, -1), (4, -1), (5, 3)]
    assert rows(answered.quarantine, "row_id", "status") == [(3, "blank_text"), (4, "blank_text")]
    again = CallableBackend(scorer()).score(answered.rows.filter("row_id < 3"), "content", "score", 30)
    assert rows(again.rows, "row_id", "score") == [(1, 9), (2, 2)]  # nothing pending: unchanged


def test_group_answers_get_notes_and_quarantine(spark):
    def reply(instruction, prompts):
        out = []
        for p in prompts:
            noted = p.startswith(protocol.NOTES[A.OMITTED])
            out.append("推理原因：1.x<sep>2.y" if noted and "never" not in p else "nothing")
        return out

    from feedback_loom.backends.calling import asker

    groups = spark.createDataFrame([("a", "some"), ("b", "never")], "g string, body string")
    task = protocol.GroupTask(A.reason_list_status, {"reasons": A.reasons_of})
    found, failed = protocol.annotate_groups(groups, "g", task, asker(reply, ""))
    assert rows(found) == [("a", "1.x,2.y")]
    assert rows(failed) == [("b", "omitted", "nothing")]


def test_wrong_number_of_answers_is_an_error(spark):
    df = spark.createDataFrame([(1, "aaa")], "row_id long, content string")
    with pytest.raises(Exception, match="0 answers for 1 prompts"):
        CallableBackend(lambda instruction, prompts: []).score(df, "content", "score", 30)


# ---- whole analysis ------------------------------------------------------------------

def model():
    """A stand-in for all six steps, told apart by the instruction."""
    bare = catalog.note_remover()

    def reply(instruction, prompts):
        out = []
        for prompt in map(bare, prompts):
            items = prompt.split("<sep>")
            if instruction.startswith("You rate"):
                out.append("<sep>".join(str(len(t) % 5) for t in items))
            elif instruction.startswith("You find why"):
                out.append("推理原因：1.long<sep>2.short")
            elif instruction.startswith("You find"):
                out.append("体验问题：1.prices<sep0>2.staff<sep1>推理原因：1.high<sep0>2.slow")
            elif instruction.startswith("You merge"):
                out.append("Labels：1.prices<sep>2.staff" if "hint" not in prompt else "1.rooms")
            elif instruction.startswith("You sort"):
                names = instruction.split("labels are: ")[1].split(".")[0].split(", ")
                out.append("<sep>".join(names[len(t) % len(names)] for t in items))
            else:
                out.append("Summary of\n" + prompt)
        return out

    return reply


def check_results(results, n_negative):
    classified = results.classified.collect()
    names = {r.label for r in results.labels.collect()}
    summary = results.class_summary.collect()
    assert len(classified) == n_negative == len({r.row_id for r in classified})
    assert {r["class"] for r in classified} <= names
    assert sum(r["count"] for r in summary) == n_negative
    assert abs(sum(r.percentage for r in summary) - 1) < 1e-9
    k = results.cluster_summary.count()
    assert sorted(r.cluster for r in results.cluster_summary.collect()) == list(range(k))
    assert {r.cluster for r in classified} <= set(range(k))
    lines = results.conclusion.orderBy("rank").collect()
    assert [r["rank"] for r in lines] == list(range(1, len(summary) + 1))
    assert [r.pct for r in lines] == sorted((r.pct for r in lines), reverse=True)
    assert results.quarantine.count() == 0


def test_offline_analysis_twice(spark, folder):
    texts = catalog.documents(spark, folder)
    negatives = catalog.negative_texts(spark, folder).count()
    runs = [analyze(texts, OfflineBackend(catalog.lexicon(spark, folder)), max_clusters=5) for _ in range(2)]
    for results in runs:
        check_results(results, negatives)
    first, second = ([(r["class"], r["count"], r["reasons"]) for r in x.class_summary.orderBy("class").collect()] for x in runs)
    assert first == second


def test_analysis_with_a_function_and_reviews(spark, folder):
    texts = texts_from(spark.read.parquet(f"{folder}/documents.parquet"), "text", "doc_id").select("row_id", "content")
    negatives = texts.filter(F.length("content") % 5 <= 3).count()
    reviews = spark.createDataFrame([(1, "n<sep>hint: one label")], "review_id int, answer string")
    team = FeedbackAnalysis(CallableBackend(model()))
    four = team.batch_run(texts, max_clusters=3, reviews=reviews)
    assert len(four) == 4
    check_results(team.results, negatives)
    assert {r.label for r in team.results.labels.collect()} == {"rooms", "其他问题"}
    assert team.results.label_status == "redone"
    assert {r.issues for r in four[0].collect()} == {"1.prices,2.staff"}
    assert {r.reasons for r in four[2].collect()} == {"1.long,2.short"}
    assert team.results.conclusion_text.first()[0].startswith("Summary of\n1. ")


def test_replaced_labels_offline(spark, folder):
    reviews = spark.createDataFrame([(1, "1.ción_bobo<sep>2.einheit")], "review_id int, answer string")
    results = analyze(catalog.documents(spark, folder), OfflineBackend(catalog.lexicon(spark, folder)), max_clusters=3,
                      reviews=reviews)
    assert [r.label for r in results.labels.orderBy("label_id").collect()] == ["ción_bobo", "einheit", "其他问题"]
    assert results.label_status == "replaced"
    assert {r["class"] for r in results.classified.collect()} <= {"ción_bobo", "einheit", "其他问题"}


def test_no_negative_texts(spark, folder):
    texts = catalog.documents(spark, folder).select("row_id", "content").limit(20)
    results = analyze(texts, CallableBackend(lambda i, prompts: ["<sep>".join("9" for _ in p.split("<sep>")) for p in prompts]))
    assert results.label_status == "no_negative_texts"
    assert [t.count() for t in results.as_list()] == [0, 0, 0, 0]
    assert results.scored.filter("score = 9").count() == 20
    assert {"tokens", "cluster", "class"} <= set(results.classified.columns)


# ---- resume, reviews, large label sets ------------------------------------------------

def test_stored_rows_can_be_resumed(spark):
    texts = spark.createDataFrame([(i, None if i % 5 == 0 else f"text {i}", "en", None) for i in range(20)],
                                  "row_id long, content string, lang string, score int")
    bare = catalog.note_remover()

    def reply(instruction, prompts):
        return ["<sep>".join("x" if "7" in t else "2" for t in bare(p).split("<sep>")) for p in prompts]

    stored, _ = score_and_store(texts, CallableBackend(reply), "content", "score", 4)
    pending = stored.filter("part = 'pending'").collect()
    assert {r.row_id for r in pending} == {0, 5, 7, 10, 15, 17} and all(r.lang == "en" for r in pending)
    assert {r.row_id: r.content for r in pending if r.row_id in (7, 17)} == {7: "text 7", 17: "text 17"}

    again, quarantine = score_and_store(stored, CallableBackend(lambda i, prompts: ["9" for _ in prompts]), "content", "score", 1)
    got = {r.row_id: r.score for r in again.collect()}
    assert got[7] == got[17] == 9 and all(got[i] == 2 for i in range(20) if i % 5 and i not in (7, 17))
    assert {r.row_id for r in quarantine.collect()} == {0, 5, 10, 15}


def test_other_texts_are_left_out_unless_wanted(spark):
    texts = spark.createDataFrame([(1, "good", "u", 9), (2, "bad", "v", 1)], "row_id long, content string, extra string, score int")
    backend = CallableBackend(lambda i, prompts: ["5" for _ in prompts])
    rows_of = lambda **rest: {r.row_id: (r.content, r.extra) for r in score_and_store(texts, backend, "content", "score", 5, **rest)[0].collect()}
    assert rows_of() == {1: (None, "u"), 2: ("bad", "v")}
    assert rows_of(keep_texts=True) == {1: ("good", "u"), 2: ("bad", "v")}


class Proposing(OfflineBackend):
    """Proposes a label per call and keeps the hints."""

    def __init__(self):
        super().__init__(None)
        self.hints = []

    def propose_labels(self, clustering, summary, hint):
        self.hints.append(hint)
        spark = clustering.texts.sparkSession
        return LabelSet(labels.label_frame(spark, [f"l{len(self.hints)}", A.FALLBACK_LABEL]), [f"l{len(self.hints)}", A.FALLBACK_LABEL])


@pytest.mark.parametrize("answers, status, hints, names", [
    (["n<sep>fewer", "junk", "n<sep>shorter", "1.one<sep>2.two"], "replaced", [None, "fewer", "shorter"], ["one", "two", A.FALLBACK_LABEL]),
    (["n<sep>fewer", "y", "n<sep>late"], "accepted", [None, "fewer"], ["l2", A.FALLBACK_LABEL]),
    (["n<sep>fewer"], "redone", [None, "fewer"], ["l2", A.FALLBACK_LABEL]),
    (["junk"], "pending_review", [None], ["l1", A.FALLBACK_LABEL]),
])
def test_reviews_go_on_until_one_decides(spark, answers, status, hints, names):
    backend = Proposing()
    given = clusters.Clustering(spark.range(1), None, None, None, 1, None)
    reviews = spark.createDataFrame(list(enumerate(answers)), "review_id int, answer string")
    found = choose_labels(backend, given, None, reviews)
    assert (found.status, backend.hints, found.names) == (status, hints, names)


def test_many_groups_merge_without_the_driver(spark):
    # 500 groups in chains of five: neighbours share most terms
    top = [(g, f"t{g // 5}_{g % 5 + j}") for g in range(500) for j in range(8)]
    merged = labels.merge_groups(spark.createDataFrame(top, "g int, term string"), "g", 0.5)
    assert {r.g: r.merged for r in merged.collect()} == {g: g - g % 5 for g in range(500)}


def test_similar_groups_are_those_of_all_pairs(spark):
    top = spark.createDataFrame([(g, f"t{(g * j * 7) % 23}") for g in range(1, 60) for j in range(1, 9)], "g int, term string").distinct()
    every = {tuple(r) for r in labels.term_overlap(top, "g").filter("jaccard >= 0.5").collect()}
    assert every and {tuple(r) for r in labels.term_overlap(top, "g", 0.5).collect()} == every


def test_repeated_lexicon_terms_count_once_on_both_paths(spark):
    texts = spark.createDataFrame([(1, "good bad bad room"), (2, "fine room"), (3, "odd")], "row_id long, content string")
    lexicon = spark.createDataFrame([("good", 1.0), ("good", 1.0), ("bad", -1.0), ("odd", 1.0), ("odd", -1.0), ("fine", 1.0)],
                                    "term string, polarity double")
    local = rows(lexicon_scores(texts, lexicon), "row_id", "score")
    assert local == rows(lexicon_scores(texts, lexicon, row_local_terms=1), "row_id", "score") == [(1, 5), (2, 10), (3, 5)]


def test_labels_are_found_in_the_row(spark, folder):
    texts, vocabulary = catalog.weighted(spark, folder)
    texts = to_table(texts, "weighted")
    means = clusters.group_means(texts, vocabulary, "lang")
    plan = clusters.nearest_in_row(texts.drop("lang"), vocabulary, means, "lang")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_shares_keep_groups_spread(spark):
    df = spark.range(1000).select((F.col("id") % 300).alias("g"))
    shares = rollup.group_shares(df, "g")
    main = shares._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in main
    assert sum(r["percentage"] for r in shares.collect()) == pytest.approx(1.0)


def test_numbers_are_dense_and_ordered(spark):
    names = spark.createDataFrame([(f"n{i:04d}",) for i in range(700)], "label string").repartition(9)
    got = rows(numbered(names, "label", "id"), "label", "id")
    assert got == [(f"n{i:04d}", i + 1) for i in range(700)]
