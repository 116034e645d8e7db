"""The pipeline: planted cases go, clean documents stay, stages equal plain versions."""

import random

import corpus_pipeline
from feedback_loom.llm import decontaminate, line_dedup, sentencepiece_codec
from feedback_loom.session import to_table


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near-duplicates", "benchmark decontamination", "SentencePiece encoding"]


def test_planted_cases(spark, tmp_path):
    rng = random.Random(0)
    word = lambda tag: f"{tag}{rng.randrange(3000)}"

    def clean(n=70):
        return " ".join(word("c") + ("." if i % 11 == 10 else "") for i in range(n))

    insults, texts = ["idiot", "moron", "pathetic", "worthless"], {}
    for i in range(120):
        texts[i] = clean()
    for i in range(120, 180):
        words = clean().split()
        for _ in range(3):
            words[rng.randrange(70)] = rng.choice(insults)
        texts[i] = " ".join(words)
    passage, item = clean(60), clean(30)
    for i in range(200, 204):
        texts[i] = f"{clean()}\n{passage}\n{clean()}"
    texts[210] = clean() + " " + item + " " + clean()
    texts[220] = clean(90)
    near = texts[220].replace(".", ",").split()
    near[5] = "other"
    texts[221] = " ".join(near)
    texts[230] = texts[0]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(120 <= i < 180)) for i in range(0, 170)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")

    kept, seen = docs, {}
    for name, run in corpus_pipeline.STAGES:
        kept = to_table(run(spark, kept, folder), "stage")
        seen[name] = {r.doc_id: r for r in kept.collect()}
        if name != "SentencePiece encoding":
            assert kept.columns == docs.columns
    assert set(seen["toxicity"]) == set(texts) - set(range(120, 180))
    lines = seen["line dedup"]
    assert passage in lines[200].text and all(passage not in lines[i].text for i in (201, 202, 203)) and 230 not in lines
    assert all(lines[i].text == texts[i] for i in range(120)) and all(r.n_chars == len(r.text) for r in lines.values())
    assert {220} <= set(seen["near-duplicates"]) and set(range(120)) <= set(seen["near-duplicates"])
    assert set(seen["near-duplicates"]) - set(seen["benchmark decontamination"]) == {210}
    last = seen["SentencePiece encoding"]
    own = sentencepiece_codec.codec(corpus_pipeline.vocabularies.path("piece_bpe_32k.model"))
    assert all(r.ids == own.model.encode(seen["benchmark decontamination"][i].text) and r.n_tokens == len(r.ids) for i, r in last.items())
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == set(last)


def test_filtering_stages_equal_their_operators(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    flagged = {r.doc_id for r in decontaminate.leaks(docs, items).collect()}
    kept = {r.doc_id for r in stage("benchmark decontamination")(spark, docs, folder).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - flagged
    texts = {r.doc_id: r.text for r in line_dedup.deduplicated(docs).collect()}
    assert all(texts[r.doc_id] == r.text for r in stage("line dedup")(spark, docs, folder).collect())
